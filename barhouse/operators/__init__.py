"""Operators over price rows: dedup, reconciliation, fingerprints, reports."""
