"""Interaction analytics on Spark: as-of features, content aggregates, state tables and serving."""

__version__ = "0.1.0"
