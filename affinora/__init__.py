"""Recommendation and merchandising analytics as PySpark DataFrame operators."""
