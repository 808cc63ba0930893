"""Operators of a training-data pipeline: filters, duplicates, mixing, archives, token output.

The rest of the package imports nothing from here. `catalogue` registers the queries.
"""
