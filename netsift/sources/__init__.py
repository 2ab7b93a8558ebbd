"""Readers: streams, files and tables."""
