"""Training-data operators (packing, deduplication, scoring, tokenisation).

Nothing else in the library imports this subpackage.
"""
