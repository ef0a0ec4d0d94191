"""DataFrame operators: filters, joins, rollups, windows, quality, ingest, models."""
