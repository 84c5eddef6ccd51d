"""Readers, writers, snapshots and run manifests."""
