"""Incremental association of arriving images."""
