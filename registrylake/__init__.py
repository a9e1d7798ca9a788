"""Spark-native analytics over public well-registry data."""
