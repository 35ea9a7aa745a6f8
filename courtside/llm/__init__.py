"""Operators for large text corpora: one module per operator, one registered query for each."""
