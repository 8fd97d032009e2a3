"""Spark DataFrame operators for product and ecosystem analytics."""

__version__ = "0.1.0"
