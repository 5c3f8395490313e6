"""lumbra: analytics over periodic portfolio filings, expressed as Spark plans."""

__version__ = "0.1.0"
