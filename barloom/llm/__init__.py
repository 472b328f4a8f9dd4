"""Operators for training corpora: deduplication, filters, scans, tokens, packing and sharding."""
