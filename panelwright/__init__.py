"""Spark-native analytics for entity-by-period performance panels."""
