"""Operators that a large training-data pipeline needs. Nothing else in the library imports this subpackage."""
