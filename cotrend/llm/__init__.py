"""Operators for large-scale training data: search, filters, dedup, mixing, tokens, languages."""
