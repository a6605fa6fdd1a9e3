"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

One module per operator, ``queries`` registers one query each, ``oracle`` holds the SQL
equivalents.  Nothing else in the library imports this package.
"""
