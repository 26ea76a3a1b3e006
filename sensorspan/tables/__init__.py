"""The partitioned telemetry tables: load, refresh, publish, retain."""
