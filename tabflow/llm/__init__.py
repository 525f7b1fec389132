"""Operators that prepare training text: scoring, counting, packing, deduplication."""
