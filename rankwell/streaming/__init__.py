"""Streaming of the competition-analytics library."""
