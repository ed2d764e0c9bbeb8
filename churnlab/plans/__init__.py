"""Composite models, checks, metrics and table rules built from the operators."""
