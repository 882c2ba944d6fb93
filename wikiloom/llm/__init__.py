"""Operators for training-data pipelines: sharding, deduplication, language ID, extraction, mixing, search and scoring."""
