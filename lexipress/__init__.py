"""Spark-native text-corpus and retrieval analytics."""

__version__ = "0.1.0"
