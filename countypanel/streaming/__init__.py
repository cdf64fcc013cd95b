"""Incremental landing of files that keep arriving."""
