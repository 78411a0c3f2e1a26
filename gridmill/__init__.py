"""Energy time-series operators for Spark DataFrames and Structured Streaming."""
