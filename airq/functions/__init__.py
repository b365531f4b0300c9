"""Column helpers: plain expressions, no Python UDFs."""
