"""orderlens: per-order customer-satisfaction features and models on Spark."""

__version__ = "0.1.0"
