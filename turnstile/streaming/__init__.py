"""Continuous loading of raw snapshots."""
