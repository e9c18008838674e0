"""Whole runs: ingest of every table, build of every model."""
