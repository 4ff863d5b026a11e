"""Plans: ingestion, gold layer, summaries and extensions."""
