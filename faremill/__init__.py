"""Cleaning, enrichment and checking of monthly trip records on Spark."""
