"""Operators for preparing training data: deduplication, scoring, tokens, archives."""
