"""Spark-native analytics for privacy-preserving document corpora."""
