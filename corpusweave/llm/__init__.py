"""Operators of a training-data pipeline: filters, near-duplicates, search, archives, mixing and tokens."""
