"""Marketplace warehouse on Spark: extract, land, upsert, clean, model, track history, test."""
