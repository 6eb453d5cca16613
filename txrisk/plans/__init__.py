"""Whole runs: the report catalog and the raw-to-scored chain."""
