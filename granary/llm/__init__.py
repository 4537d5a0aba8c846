"""Operators for text and vector corpora that feed model training."""
