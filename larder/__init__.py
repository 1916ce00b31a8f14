"""Product catalogue analytics on Spark: clean table, star schema, reports and audits."""
