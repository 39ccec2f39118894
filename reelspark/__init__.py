"""Spark-native analytics over multi-camera recording archives and motion tracks."""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
