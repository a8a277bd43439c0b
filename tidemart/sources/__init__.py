"""Readers of topics, change captures and tables."""
