"""fleetlake: server-fleet metrics analytics as Spark DataFrame jobs."""
