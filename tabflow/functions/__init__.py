"""Column builders and schemas."""
