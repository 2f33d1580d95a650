"""Operators for training data: sharding, tokens, fingerprints, scoring, filters, near-duplicates, packing."""
