"""Scans, sinks, config sheets and dimension tables."""
