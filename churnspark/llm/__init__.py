"""Operators of a training-data pipeline: scans, joins, removal, scoring, counting and mixing of documents."""
