"""Operators for training-data pipelines: near duplicates, tokens, decontamination, privacy, quality and layout."""
