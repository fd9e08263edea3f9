"""Dataset curation and publishing on Spark: ingest, conform, validate, publish, diff, report."""
