"""Operators for large-scale training-data pipelines over text and vectors."""
