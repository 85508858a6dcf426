"""Extraction, landing, nested records and versioned tables."""
