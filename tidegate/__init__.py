"""Spark-native incremental ingest and data-quality engine."""
