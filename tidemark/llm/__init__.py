"""Operators for training data made of text: pairs, names, matching, deduplication, tokens, mixing, reading levels.

Nothing outside this package imports it."""
