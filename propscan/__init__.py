"""Property-listing scouting as Spark DataFrame, SQL and Structured Streaming jobs."""
