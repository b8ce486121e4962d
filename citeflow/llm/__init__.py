"""Operators for preparing training data: filters, near-duplicates, mixing, token files.

Nothing else in the library imports this package.
"""
