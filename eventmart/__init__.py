"""Shop-event analytics as PySpark DataFrame, SQL and Structured Streaming jobs."""
