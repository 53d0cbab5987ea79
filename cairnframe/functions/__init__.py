"""Column builders: pure functions from columns to columns, without a session or a UDF."""
