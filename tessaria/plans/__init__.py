"""Schemas, descriptors, and the catalogue of queries."""
