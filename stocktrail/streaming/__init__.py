"""Structured Streaming jobs over run events and state changes."""
