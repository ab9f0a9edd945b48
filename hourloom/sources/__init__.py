"""Scans and sinks (A1-A10)."""
