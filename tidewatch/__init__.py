"""Financial-crime monitoring as plain Spark DataFrame jobs."""
