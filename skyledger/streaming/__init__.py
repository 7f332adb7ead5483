"""Structured Streaming forms of the repeated incremental loads (ST1-ST4)."""
