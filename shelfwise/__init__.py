"""Retail analytics operators on Spark DataFrames."""
