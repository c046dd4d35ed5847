"""Scans over landed data."""
