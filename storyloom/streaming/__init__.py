"""Continuous ingestion, beyond the batch operators."""
