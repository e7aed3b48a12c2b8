"""Operators for large training-text corpora (documents, pages, benchmarks).

Each module holds one operator with its own docstring: the method, the
parameters, and what null, empty, repeated and very long inputs give.
``queries`` registers the thin ``opN_*`` queries over the tables.
"""
