"""Air-quality measurement analytics on Spark: payload ingest, star-schema upkeep, daily alerts."""

__version__ = "0.1.0"
