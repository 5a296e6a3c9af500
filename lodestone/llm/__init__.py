"""Operators for preparing large text corpora: packing, deduplication, filtering, search and counting."""
