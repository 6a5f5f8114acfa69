"""Operators for large text corpora: deduplication, packing, token counts, sharding, filters."""
