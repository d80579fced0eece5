"""Operators for training-data pipelines: filtering, deduplication, mixing, models, tokens."""
