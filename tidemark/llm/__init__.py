"""Operators for preparing training data: extraction, cleaning, deduplication, tokenizing and packing.

Nothing else in the library imports this package.
"""
