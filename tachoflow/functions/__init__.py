"""Column functions. All of them are built-in expressions, so they run in batch and streams."""
