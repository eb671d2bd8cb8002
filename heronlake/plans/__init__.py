"""Registered queries, their adapters to the test tables, and the SQL they are compared with."""
