"""Whole loads: from a directory of files to published tables."""
