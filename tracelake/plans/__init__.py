"""Registered queries, their inputs and the SQL they equal."""
