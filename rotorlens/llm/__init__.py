"""Operators for preparing training data: filters, deduplication, mixing, packing, neighbours, token files.

Nothing else in the library imports this subpackage.
"""
