"""Whole queries: what the operators compute over given tables."""
