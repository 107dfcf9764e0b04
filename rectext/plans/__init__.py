"""Composite jobs, table-derived inputs and the query set."""
