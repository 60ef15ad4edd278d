"""Operators for preparing training text: deduplication, filters, mixing, packing, search.

Nothing else in the library imports this package. Every operator takes the columns it
needs by name, so further columns of the input never clash with its own.
"""
