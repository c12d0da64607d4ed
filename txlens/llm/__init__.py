"""Operators for training-data pipelines: deduplication, filtering, classification, mixing."""
