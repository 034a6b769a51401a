"""Structured Streaming adapters for the stateless row-level operators."""
