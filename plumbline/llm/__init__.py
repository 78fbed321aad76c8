"""Operators for training-data pipelines: mixing, filters, deduplication, extraction, scoring, formatting and packing."""
