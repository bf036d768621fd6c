"""Per-frame video analytics on Spark DataFrames."""
