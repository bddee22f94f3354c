"""Incremental order analytics on Spark: JSON order documents to a star schema."""

__version__ = "0.1.0"
