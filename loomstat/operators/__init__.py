"""Operators: DataFrame in, DataFrame (or fitted Spark ML model) out."""
