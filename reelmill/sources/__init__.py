"""Readers, table sinks, fingerprints and the ingestion log."""
