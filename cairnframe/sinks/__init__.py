"""Release rows, tables and files."""
