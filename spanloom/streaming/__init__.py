"""Structured Streaming form of the plan."""
