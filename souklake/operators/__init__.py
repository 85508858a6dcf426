"""Operators over DataFrames: lookups, upserts, history and data-quality checks."""
