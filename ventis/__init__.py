"""Station measurement analytics on Spark: cleaning, quality, ingest, rankings, models."""

__version__ = "0.1.0"
