"""Operators of a training-data pipeline: packing, deduplication, scoring, archives."""
