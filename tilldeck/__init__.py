"""Retail lakehouse analytics as plain DataFrame transformations on Spark."""
