"""Readers of records, tables and shapes."""
