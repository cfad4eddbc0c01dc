"""Readers, landing and upsert writers."""
