"""Operators of a training-data pipeline: deduplication, filtering, scanning, mixing, sharding.

Nothing else in the library imports this subpackage.
"""
