"""Functions of the competition-analytics library."""
