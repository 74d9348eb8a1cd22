"""Operators that prepare training text: near-duplicates, filters, tokens and scores.

Nothing else in the library imports this package.
"""
