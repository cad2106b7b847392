"""Operators for preparing training data on Spark. Nothing else in the library imports this package."""
