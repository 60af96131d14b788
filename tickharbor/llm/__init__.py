"""Operators for training text: fingerprints, language, personal data, extraction, deduplication, packing."""
