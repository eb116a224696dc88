"""Operators for training-data pipelines over text, page and vector tables.

Each module holds one operator with its own general interface; ``queries`` derives the registered
queries from them. Nothing else in the library imports this package.
"""
