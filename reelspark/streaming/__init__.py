"""File intake and retraining as Structured Streaming jobs."""
