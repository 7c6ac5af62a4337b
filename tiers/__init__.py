"""Tiered feed analytics on Spark: raw text feeds to bronze, silver and gold tables."""
