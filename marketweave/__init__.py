"""marketweave: market data and market text analytics as Spark DataFrame jobs."""
