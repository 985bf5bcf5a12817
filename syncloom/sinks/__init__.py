"""Feeds that go out."""
