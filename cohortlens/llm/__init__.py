"""Operators of a training-data pipeline (scoring, deduplication, packing,
decontamination, language identification, archives, search, extraction).

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; `queries.py` holds the thin queries.
"""
