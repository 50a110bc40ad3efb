"""Operators and queries for training-data pipelines (language, duplicates, licences, mixing, tokens, search)."""
