"""Operators of a training-data pipeline over tables of documents, pages and embeddings.

Nothing else in the library imports this subpackage. Each module holds one operator with its own
general interface; ``queries`` applies them to the given tables.
"""
