"""Market time series on Spark: bronze, silver and gold tables as DataFrame jobs."""
