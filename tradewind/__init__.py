"""Commerce analytics on Spark: log splitting, change routing, daily actives, order joins, document queries."""
