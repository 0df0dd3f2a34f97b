"""Retail order analytics as Spark DataFrame, SQL and Structured Streaming jobs."""
