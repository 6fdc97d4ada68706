"""Structured Streaming jobs over the real-time feeds."""
