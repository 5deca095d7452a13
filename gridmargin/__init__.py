"""Hourly electricity-grid reliability analytics on Spark DataFrames."""
