"""Spark-first discovery-query bank, relevance scoring and candidate registry."""
