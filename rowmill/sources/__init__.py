"""Readers and writers for tables, feature metadata, models and reports."""
