"""Structured Streaming jobs that keep the views current."""
