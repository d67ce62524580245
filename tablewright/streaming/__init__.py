"""Incremental landing of paged responses."""
