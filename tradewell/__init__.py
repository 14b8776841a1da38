"""Batch sales analytics on Spark: landing, quality, history, star schema, measures."""
