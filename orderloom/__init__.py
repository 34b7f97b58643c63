"""Order-level data preparation as Spark jobs."""
