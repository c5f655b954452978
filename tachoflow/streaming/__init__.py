"""Incremental ingestion, the live tables and stream de-duplication."""
