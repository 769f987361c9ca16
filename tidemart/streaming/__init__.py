"""Structured Streaming jobs. Frame-to-frame functions also run on batch frames."""
