"""Joins, aggregates, graph steps, searches and summaries."""
