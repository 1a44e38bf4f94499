"""Operators for training-data corpora: cleaning, deduplication, mixing, search, archives, tokens."""
