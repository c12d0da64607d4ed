"""Readers, writers, schemas and lookup tables."""
