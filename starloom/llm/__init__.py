"""Operators for training data: scoring, decontamination, counting, deduplication, filtering, privacy and encoding."""
