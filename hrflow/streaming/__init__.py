"""Structured Streaming jobs: message monitoring (T1-T4) and file ingest (K8)."""
