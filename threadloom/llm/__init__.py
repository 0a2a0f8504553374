"""Operators of a training-data pipeline: filtering, deduplication, scans, packing, formatting."""
