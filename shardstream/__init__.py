"""Sharded record logs as DataFrames and Structured Streaming sources."""
