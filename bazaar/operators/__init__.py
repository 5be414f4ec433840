"""bazaar: market analytics on Spark."""
