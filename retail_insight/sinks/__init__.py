"""Sinks: JDBC append, table overwrite, keyed upsert log."""
