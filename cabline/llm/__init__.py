"""Operators for training-data pipelines: encoding, formatting, deduplication, filtering,
scoring and mixing, each on plain DataFrames. Nothing outside this subpackage imports it."""
