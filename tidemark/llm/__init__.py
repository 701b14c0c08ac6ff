"""Training-data operators: dedup, quality, packing, extraction, filters, search and mixing.

Nothing else in the library imports this subpackage.
"""
