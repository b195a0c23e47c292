"""millrace: entity, document and event analytics expressed as Spark DataFrame jobs."""
