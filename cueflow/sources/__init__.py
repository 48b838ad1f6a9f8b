"""Scans of tables and files."""
