"""Scans: nested payloads, uploaded statements, incremental reads, small lookups."""
