"""Versioned state tables."""
