"""Ingest (all-text scan, lineage, fingerprints, reconciliation) and sinks."""
