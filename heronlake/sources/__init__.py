"""Readers and writers: JSON lines, legacy CSV, RSS, HTML articles, tables."""
