"""Registered queries over the order tables and their DuckDB counterparts."""
