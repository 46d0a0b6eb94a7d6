"""Column functions: names and times, vectors, payloads."""
