"""Queries over the synthetic tables and the SQL that gives the same rows."""
