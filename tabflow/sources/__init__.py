"""Scans: tables, lines, registries, job configurations, message streams."""
