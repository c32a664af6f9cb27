"""Sinks: partitioned tables (upsert / overwrite), CSV exports, JSON reports."""
