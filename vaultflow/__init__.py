"""Banking transaction analytics as Spark jobs, in batch and in Structured Streaming."""
