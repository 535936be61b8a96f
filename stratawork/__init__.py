"""Spark-native document, message and inventory analytics."""
