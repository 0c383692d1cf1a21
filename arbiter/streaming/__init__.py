"""Structured Streaming forms of the decision, window and communication jobs."""
