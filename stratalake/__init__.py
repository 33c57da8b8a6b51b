"""Layered table building on Spark: ingest, decode, flatten, check, summarise, publish."""

__version__ = "0.1.0"
