"""Cleaning, keyed loading, integrity, ranking, medians and storage on DataFrames."""
