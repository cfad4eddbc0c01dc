"""Tidewright: data operators for layered event-and-interval pipelines on Spark."""
