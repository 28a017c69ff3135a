"""Tabular feature and model flows on Spark DataFrames."""

__version__ = "0.1.0"
