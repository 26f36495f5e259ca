"""Operators of the competition-analytics library."""
