"""Payment-risk analytics as plain Spark DataFrame and Structured Streaming functions."""
