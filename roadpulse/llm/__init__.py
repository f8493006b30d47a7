"""Operators for preparing text corpora and embeddings; nothing outside this folder needs them."""
