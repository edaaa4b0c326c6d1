"""Loads and reports built from the operators."""
