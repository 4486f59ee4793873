"""Structured Streaming wrappers over the same operators."""
