"""End-of-day table maintenance on Spark DataFrames."""
