"""Metric registry, semantic queries, guarded SQL and lexical search."""
