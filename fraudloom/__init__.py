"""Payment-fraud analytics on Spark DataFrames."""
