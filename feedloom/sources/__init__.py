"""Readers for hour files, recorded feeds, growing files and the package's tables."""
