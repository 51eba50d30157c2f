"""Cleaning, data quality, reports, and the batch jobs built from them."""
