"""Relational operators: filters, aggregates, joins, windows, checks, policies, snapshots."""
