"""Spark-native analytics for building and auditing retrieval datasets."""
