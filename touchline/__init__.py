"""Tracking analytics on Spark: frames, nearest opponents and possession sequences."""
