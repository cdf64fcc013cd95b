"""County-by-year panel analytics as Spark DataFrame operations."""
