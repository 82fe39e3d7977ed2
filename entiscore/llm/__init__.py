"""Operators of a training-data pipeline over ``documents``-like tables.

Every module holds one operator with its own parameters and outputs; the thin
queries over the driver tables are in :mod:`entiscore.llm.queries`.
"""
