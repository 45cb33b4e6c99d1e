"""Flight-movement analytics on Spark DataFrames."""
