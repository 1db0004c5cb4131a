"""Scans and sinks: landing JSON, bronze table, taxonomy seed, test tables."""
