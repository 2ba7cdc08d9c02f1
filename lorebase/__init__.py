"""Documentation retrieval, question answering over SQL and business metrics as Spark jobs."""
