"""Compositions of operators and the registered query catalogue."""
