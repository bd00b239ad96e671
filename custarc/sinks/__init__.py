"""Materialising tables and exporting marts to files."""
