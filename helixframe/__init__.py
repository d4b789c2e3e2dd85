"""Structural-data preparation on Spark DataFrames."""
