"""Readers and writers with declared schemas, and queries of what violates them."""
