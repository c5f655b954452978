"""Layered tables and the batch build."""
