"""civicflow: service-request analytics on Spark (ingest, models, questions, checks)."""

__version__ = "0.1.0"
