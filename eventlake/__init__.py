"""eventlake: click-event analytics written as plain Spark DataFrame jobs."""
