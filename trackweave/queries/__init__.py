"""Queries over the derived fixtures, each with the SQL that an independent engine runs."""
