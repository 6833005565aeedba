"""Corpus operators for training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
holds the thin ``opN_<name>`` queries over the driver tables.  Nothing outside
this subpackage imports it.
"""
