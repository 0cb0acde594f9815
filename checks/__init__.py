"""Queries on the synthetic tables and the SQL to compare them with."""
