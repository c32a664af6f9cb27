"""Composite jobs: forecast tables, drift, export, training, evaluation, promotion."""
