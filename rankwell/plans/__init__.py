"""Plans of the competition-analytics library."""
