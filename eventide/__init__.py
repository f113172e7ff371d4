"""eventide: web user-event analytics as Spark DataFrame jobs."""
