"""Relational crawl operators: DataFrames in, DataFrames out."""
