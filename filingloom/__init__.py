"""Corporate filings on Spark: from landed announcements to numbered report tables."""
