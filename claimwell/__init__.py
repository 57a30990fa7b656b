"""Claims lakehouse on Spark: check, mask, enrich, summarise and audit claim files."""
