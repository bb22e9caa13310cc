"""Operators of a training-data pipeline: search, mixing, near-duplicates, packing, filters.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query per
operator; ``corpus_pipeline.py`` at the top of the repository chains five of them.
"""
