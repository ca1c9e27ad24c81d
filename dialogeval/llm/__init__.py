"""Operators of a training-data pipeline: fingerprints, joins, scans, archives, extraction and mixing."""
