"""Training-data operators: packing, deduplication, search, scans, scoring, tokenizing, chat formatting.

Nothing else in the library imports this subpackage.
"""
