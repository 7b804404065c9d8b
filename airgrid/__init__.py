"""Hourly sensor series for many stations at once, on Spark DataFrames."""
