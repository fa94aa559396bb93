"""Operators for training-data corpora: filtering, deduplication, tokens and mixing."""
