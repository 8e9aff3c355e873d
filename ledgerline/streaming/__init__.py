"""Structured Streaming forms of the incremental load and feature adoption."""
