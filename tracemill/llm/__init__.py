"""Operators for preparing language-model training data.

Every operator has a general interface of its own; ``queries.py`` applies each
to the given tables. Nothing outside this package imports it.
"""
