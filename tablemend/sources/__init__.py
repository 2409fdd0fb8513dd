"""Scans and file readers."""
