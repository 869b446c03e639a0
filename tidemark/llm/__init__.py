"""Operators for training-data pipelines: extraction, deduplication, filtering, scoring, search, mixing, archives.

Nothing else in the library imports this subpackage.
"""
