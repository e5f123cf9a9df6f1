"""Outcome analytics on Spark: rates, models and error analysis for a binary outcome."""

__version__ = "0.1.0"
