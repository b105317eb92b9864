"""Column expressions: text splitting and association statistics."""
