"""Spark-native analytics over transcripts and other long-form text."""

__version__ = "0.1.0"
