"""Customer analytics as Spark DataFrame operators."""
