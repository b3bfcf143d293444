"""Incremental intake of report files."""
