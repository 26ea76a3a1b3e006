"""Composed jobs: ingest pipeline, dashboard panels, analysis queries."""
