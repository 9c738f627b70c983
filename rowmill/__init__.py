"""Spark-native engine that turns messy tabular records into model-ready features and scored results."""

__version__ = "0.1.0"
