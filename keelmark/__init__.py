"""Keelmark: contract-driven data products on Spark."""
