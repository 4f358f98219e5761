"""Operators over texts and algorithms for very large keys: percentiles, groups, linkage, tokens."""
