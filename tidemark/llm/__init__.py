"""Operators of a training-data pipeline: extraction, near duplicates, scans, filters and tokens."""
