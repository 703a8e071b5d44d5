"""Trip analytics on PySpark: ingest, enrich, report, rank and graph operators."""
