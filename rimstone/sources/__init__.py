"""Readers of landed files and catalog tables."""
