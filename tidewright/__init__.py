"""Spark-native analytics over developer-activity events."""
