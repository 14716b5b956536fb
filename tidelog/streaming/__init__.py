"""Structured Streaming operators and micro-batch actions."""
