"""Operators for training-data pipelines: extraction, scoring, filtering, joins, packing, sharding."""
