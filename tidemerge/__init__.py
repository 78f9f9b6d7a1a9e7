"""Keyed table sync, conversation normalisation and data-quality reports as Spark jobs."""

__version__ = "0.1.0"
