"""Lectern: content-corpus processing on Spark DataFrames and streams."""
