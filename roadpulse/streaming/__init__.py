"""Continuous ingest and live queries."""
