"""Operators for large text corpora (training-data preparation). Nothing else in fieldmart imports this package."""
