"""Retail and logistics analytics as plain Spark jobs."""
