"""Whole runs and the query registry."""
