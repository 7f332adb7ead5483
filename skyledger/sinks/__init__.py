"""Sinks and table maintenance (K1-K9)."""
