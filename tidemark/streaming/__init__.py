"""Structured Streaming twins of the scheduled jobs. With an available-now trigger they give the batch answer."""
