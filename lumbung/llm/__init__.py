"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``queries.py`` binds them to the tables.
"""
