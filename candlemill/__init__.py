"""Market bars on Spark: archive reading, incremental loading and indicators."""
