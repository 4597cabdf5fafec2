"""Joins, windows and aggregations over listing tables."""
