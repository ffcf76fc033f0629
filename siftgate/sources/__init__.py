"""Readers, sinks and the places files and tables live."""
