"""Whole flows and reports made of the operators."""
