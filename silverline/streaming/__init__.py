"""Structured Streaming jobs (STM-1..3)."""
