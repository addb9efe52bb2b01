"""Operators of a training-data pipeline: filters, deduplication, mixing, tokens."""
