"""Monthly lakehouse analytics on Spark: contract, rules, star schema, marts and live tail."""
