"""Amplicon analytics on Spark DataFrames."""
