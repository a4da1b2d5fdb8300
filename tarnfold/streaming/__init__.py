"""Streams of published snapshots."""
