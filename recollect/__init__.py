"""Spark-native memory retrieval and text analytics."""

__version__ = "0.1.0"
