"""Operators of a training-data pipeline: scoring, encoding, packing, search and near-duplicates."""
