"""Summaries of tables that grow file by file."""
