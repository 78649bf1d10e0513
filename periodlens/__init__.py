"""Entity-quarter risk panels on Spark DataFrames."""
