"""Schemas, readers, writers and generated data."""
