"""Usage analytics on Spark: sources, shaping, period aggregates, reports and monitors."""
