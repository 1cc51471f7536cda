"""Relational steps: preparation, aggregates, joins, upserts and ordered passes."""
