"""Structured Streaming: one ingest handler with a ledger, and its sinks: scoring, exports of reopened
days, the master history, and a 5-minute resample with retractions."""
