"""Structured Streaming jobs over hub tables."""
