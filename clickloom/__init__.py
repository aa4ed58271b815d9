"""Clickstream analytics as Spark jobs: batch DataFrames and Structured Streaming."""
