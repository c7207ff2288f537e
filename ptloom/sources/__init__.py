"""Scans and sinks: driver tables, JSONL text, CSV curves."""
