"""Relational operators over readings: clean, resample, interpolate, profile,
order, dedup, sequences, metrics."""
