"""Readers: newline-delimited JSON, the bronze table, the seed and recorded sensor rows."""
