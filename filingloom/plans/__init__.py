"""Jobs: ingest a batch, recheck, plan a backfill, remove duplicates."""
