"""Operators for preparing training data: sharding, filtering, deduplication, redaction, token counts and packing."""
