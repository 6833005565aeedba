"""Whole jobs: panel replay, reverse replay, reports, and the catalogue of queries."""
