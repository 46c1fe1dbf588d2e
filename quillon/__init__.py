"""Quillon: exploration, cleaning, features, temporal validation and top-k evaluation on Spark DataFrames."""
