"""Operators for training-data pipelines: packing, extraction, dedup, scoring, search."""
