"""Surface-temperature analytics on Spark DataFrames."""
