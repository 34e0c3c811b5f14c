"""Spark-native product search, recommendation and warehouse preparation."""
