"""Declarative masking of personal data over Spark DataFrames."""

__version__ = "0.1.0"
