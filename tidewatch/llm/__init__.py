"""Training-data operators: deduplication, mixing, packing, media, scoring and archive writing.

Nothing else in the library imports this subpackage.
"""
