"""Delay prediction on Spark: clean, encode, train, score and replay flight records."""
