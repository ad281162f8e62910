"""Operators for preparing training text and vectors: cleaning, deduplication, mixing, tokens, search."""
