"""Operators for training-data pipelines: mixing, tokens, quality, duplicates, extraction, search."""
