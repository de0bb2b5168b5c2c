"""Structured Streaming jobs over successive snapshots, and their batch twins."""
