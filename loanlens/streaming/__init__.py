"""Structured Streaming jobs: alerts and the incremental warehouse load."""
