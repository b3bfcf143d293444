"""Royalty and music-metrics analytics as DataFrame transformations."""
