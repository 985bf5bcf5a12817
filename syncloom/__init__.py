"""Incremental sync analytics on Spark: detect, resolve and publish changes."""
