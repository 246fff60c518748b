"""Text-corpus analytics on Spark: cleaning, routing, deduplication, curation and release reports."""
