"""Operators for large training-data pipelines (deduplication, packing, classifiers, tokenizers)."""
