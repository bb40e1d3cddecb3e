"""End-of-day market data on Spark: universes, price gates, flags, run log, upkeep."""
