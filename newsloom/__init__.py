"""Spark-first analytics for news-like text: linking, deduplication, topics, graphs and training-data operators."""
