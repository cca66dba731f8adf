"""Spark-native entity resolution and knowledge-graph engine."""

__version__ = "0.1.0"
