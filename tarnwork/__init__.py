"""Document-ingestion analytics on Spark: DataFrame transformations from queued files to chunks, vectors and status."""
