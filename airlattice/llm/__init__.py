"""Operators for large training corpora: extraction, duplicates, quality, privacy, mixing, tokens, search."""
