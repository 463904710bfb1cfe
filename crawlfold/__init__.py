"""Crawl-data engine on Spark: extraction, upsert, claims and pool ledgers."""
