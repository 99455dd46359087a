"""Structured Streaming jobs: tick landing and live bars (same operators as batch)."""
