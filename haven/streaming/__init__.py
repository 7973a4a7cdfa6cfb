"""Structured Streaming jobs: topic bronze, dedupe, windows, dead letters."""
