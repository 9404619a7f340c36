"""Structured Streaming: continuous upsert of micro-batches."""
