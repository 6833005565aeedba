"""Relational operators on registry tables: keyed changes, dedup, summaries, change detection, intervals, checks."""
