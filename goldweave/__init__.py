"""Goldweave: a PySpark engine that turns messy person and company records into trusted master data."""
