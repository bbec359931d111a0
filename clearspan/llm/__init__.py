"""Operators that prepare text for training language models.

Nothing else in the library imports this package. ``queries`` registers one query per operator.
"""
