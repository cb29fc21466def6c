"""Operators for training data: near duplicates, decontamination, tokens, archives and quality."""
