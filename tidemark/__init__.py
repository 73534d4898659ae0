"""Point-in-time analytics operators on Spark DataFrames."""
