"""Operators for preparing training text: fingerprints, quality, joins, scans, mixing, scoring."""
