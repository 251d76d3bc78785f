"""Analytics jobs on Spark DataFrames, Spark SQL and Structured Streaming."""
