"""Operators of a training-data pipeline: quality, deduplication, mixing, packing, sharding, personal data, archives.

Nothing outside this package imports it.
"""
