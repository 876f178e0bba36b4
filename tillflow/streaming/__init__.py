"""Structured Streaming feeds into Bronze and Silver."""
