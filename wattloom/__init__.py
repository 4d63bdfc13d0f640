"""Spark-native analytics over hourly, per-entity readings."""
