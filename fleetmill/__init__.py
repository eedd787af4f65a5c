"""Fleet movement analytics on Spark DataFrames."""
