"""Operators for training-data corpora: filters, near copies, token work."""
