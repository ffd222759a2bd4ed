"""Comment analytics on Spark: clean, score, aggregate, check and evaluate comment tables."""
