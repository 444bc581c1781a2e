"""Operators for building training data: tokens, packing, duplicates, search, text, mixing."""
