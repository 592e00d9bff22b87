"""postlume: incremental post enrichment as Spark DataFrame jobs."""

__version__ = "1.0.0"
