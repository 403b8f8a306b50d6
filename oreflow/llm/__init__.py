"""Operators for training-data pipelines, with their named queries and SQL equivalents."""
