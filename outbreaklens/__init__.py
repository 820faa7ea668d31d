"""Outbreak-surveillance analytics on Spark DataFrames."""
