"""Streaming forms, each with a batch form of the same result."""
