"""Public-spending analytics on Spark: ingest, resolve, check and report payments."""
