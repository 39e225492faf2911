"""Structured Streaming import."""
