"""Frame-level building blocks: deduplication, upsert, dates, measures."""
