"""Sources of the competition-analytics library."""
