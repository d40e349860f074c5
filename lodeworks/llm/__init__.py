"""Operators for preparing text corpora: filtering, deduplication, packing, search."""
