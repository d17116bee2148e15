"""Pipeline operators for Apache Spark: scan, clean, model, upsert, audit, export."""

__version__ = "0.1.0"
