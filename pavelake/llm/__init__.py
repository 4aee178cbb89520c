"""Operators for preparing text corpora and embeddings for model training."""
