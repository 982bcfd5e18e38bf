"""Scans and sinks: session logs, statistics tables, records."""
