"""Product-telemetry analytics as Spark DataFrame, SQL, streaming and MLlib jobs."""
