"""Operators of a training-data pipeline: fingerprints, filters, near-duplicates, mixing, tokens, personal data."""
