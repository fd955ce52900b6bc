"""Daily channel-performance facts on Spark DataFrames."""
