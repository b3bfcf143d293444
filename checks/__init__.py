"""Queries on the driver tables and the SQL their results are compared with."""
