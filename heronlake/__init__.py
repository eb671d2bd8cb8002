"""Heronlake: news analytics and corpus preparation on Spark DataFrames."""
