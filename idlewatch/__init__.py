"""Hourly utilisation and wastage of reserved cloud capacity, on Spark."""
