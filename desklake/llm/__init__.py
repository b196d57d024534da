"""Operators for training data: duplicates, language, packing, sharding, decontamination, quality and chat formatting."""
