"""Retrieval and recommendation analytics on Spark DataFrames."""
