"""Contract-driven ingestion, data quality and loan risk analytics on Spark DataFrames."""

__version__ = "0.1.0"
