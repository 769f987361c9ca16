"""Reusable building blocks of the data jobs."""
