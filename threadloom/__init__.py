"""Support-conversation analytics as Spark DataFrame, SQL, MLlib and Structured Streaming jobs."""

__version__ = "0.1.0"
