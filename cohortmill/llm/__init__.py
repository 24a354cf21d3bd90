"""Operators for preparing training data: cleaning, deduplicating, mixing, formatting and packing."""
