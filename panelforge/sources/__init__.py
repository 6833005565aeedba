"""Readers of registry dumps, lookups and panels."""
