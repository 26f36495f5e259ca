"""Operators for large training-data pipelines over `documents`, `pages` and `embeddings`."""
