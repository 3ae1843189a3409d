"""duskwatch: security-telemetry analytics as plain Spark jobs."""
