"""Operators for preparing text corpora: deduplication, language, tokens, shards and packing."""
