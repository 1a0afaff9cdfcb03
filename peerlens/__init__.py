"""Organisation similarity on Spark: feature tables, neighbours, clusters."""
