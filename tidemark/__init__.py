"""Spark-native building blocks for a subscription-business lakehouse."""
