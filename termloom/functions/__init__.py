"""Column expressions: tokenizing, weighting, scoring and sparse-vector text."""
