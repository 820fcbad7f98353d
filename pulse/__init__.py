"""Spark-native analytics for social and user-generated data."""
