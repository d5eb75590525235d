"""Reading JSON objects into all-string staging tables."""
