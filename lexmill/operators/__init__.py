"""Transforms that combine rows: splits, joins, aggregates, models."""
