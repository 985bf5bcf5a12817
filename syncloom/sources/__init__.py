"""Scans and feeds that come in."""
