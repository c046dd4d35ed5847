"""Whole workflows, and the catalog of queries with their SQL twins."""
