"""Streaming forms of the operators that need state of their own, and query runners."""
