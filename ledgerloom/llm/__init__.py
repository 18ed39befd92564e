"""Operators for training data: mixing, sharding, tokens, extraction, duplicates, packing, filters."""
