"""Readers and writers for panels, tables, models and exports."""
