"""Sales star schema and report marts, written as Spark DataFrame jobs."""
