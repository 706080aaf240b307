"""Scans: delimited files, nested bronze files and incremental table reads."""
