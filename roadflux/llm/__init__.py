"""Training-data operators.  Nothing else in the library imports this package.

Every operator takes and returns DataFrames; the thin ``opN`` queries that the
entry file registers live in :mod:`roadflux.llm.queries`.
"""
