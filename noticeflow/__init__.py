"""Notice extraction, ingest, de-duplication and reporting as Spark DataFrame jobs."""
