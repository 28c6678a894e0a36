"""Operators of a training-data pipeline over raw text: packing, filters, deduplication, personal data, quality,
tokens, archives and fingerprints. Nothing outside this folder imports it."""
