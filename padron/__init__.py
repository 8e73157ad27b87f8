"""Monthly registry panels on Spark: ingest, aggregate, compare, report."""
