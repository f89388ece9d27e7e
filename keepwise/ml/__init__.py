"""Spark ML: training-table preparation, the forest pipeline and evaluation metrics."""
