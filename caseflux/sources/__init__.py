"""Scans, extracts, reference tables and sinks."""
