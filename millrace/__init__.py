"""millrace: record ingestion and business reporting as Spark plans."""
