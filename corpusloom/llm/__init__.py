"""Operators for training data: token budgets, text quality, deduplication, packing, contamination, mixing and splitting."""
