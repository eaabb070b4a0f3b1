"""tidewell: data-quality, ingest and upsert operators for a subscription business on Spark."""

__version__ = "0.1.0"
