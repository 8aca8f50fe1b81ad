"""Jobs: the daily ETL and report, backfills, and the registered queries."""
