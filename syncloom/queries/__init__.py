"""Registered queries, their stand-in tables and their check SQL."""
