"""Operators that prepare training data: grouping, sampling, matching, packing, mixing and content scores."""
