"""Operators of a training-data pipeline: search, filtering, deduplication, mixing, packing.

Nothing else in the library imports this subpackage.
"""
