"""Analytics on daily time series, and training-data operators, as Spark jobs."""
