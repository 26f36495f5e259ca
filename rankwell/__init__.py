"""Competition analytics as Spark jobs."""
