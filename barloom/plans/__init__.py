"""Compositions of operators: ingest, training, inference and the query catalogue."""
