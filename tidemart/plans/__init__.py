"""Data jobs by subject: dimensions, facts, summaries and reports."""
