"""Operators of a training-data pipeline (documents, tokens, vectors).

Nothing else in the library imports this subpackage.
"""
