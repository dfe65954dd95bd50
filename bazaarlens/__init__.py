"""Retail marketplace analytics as ordinary Spark DataFrame jobs."""
