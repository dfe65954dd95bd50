"""Staging, intermediate and mart tables, data-quality checks and the analysis queries."""
