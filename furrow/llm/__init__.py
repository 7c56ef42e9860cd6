"""Operators for training-data pipelines; nothing else in furrow imports this package."""
