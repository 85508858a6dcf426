"""Cleaning models, mart models and the pipelines that chain them."""
