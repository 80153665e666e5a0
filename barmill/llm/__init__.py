"""Operators for preparing training data: cleaning, deduplication, packing, search."""
