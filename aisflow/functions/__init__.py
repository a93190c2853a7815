"""Column functions: geodesy and code-book decoding."""
