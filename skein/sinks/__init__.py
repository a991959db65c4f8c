"""Sinks: canonical JSON, artifacts that are written once, deterministic archives."""
