"""Operators for large training-data corpora. Nothing else in cueflow imports this subpackage."""
