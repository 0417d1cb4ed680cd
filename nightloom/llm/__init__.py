"""Operators for large training-data pipelines: deduplication, filters, extraction, sharding and packing.

Nothing outside this package imports it.
"""
