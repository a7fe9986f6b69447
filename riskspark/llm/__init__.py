"""Operators for training-data pipelines: tokenising, deduplication, extraction, filtering, scoring."""
