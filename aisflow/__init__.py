"""Ship position (AIS) analytics as Spark DataFrame operations."""
