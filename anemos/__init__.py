"""Forecast-feature, scoring and monitoring jobs on Spark DataFrames."""

__version__ = "0.1.0"
