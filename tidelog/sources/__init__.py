"""Readers for log files, topics and stored tables."""
