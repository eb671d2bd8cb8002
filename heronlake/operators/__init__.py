"""Operators over DataFrames: dedup and merge, events and rollups, trends, search, access, profiles, reports."""
