"""sparkprep: listing-table preparation, text mining and model evaluation as
Spark DataFrame / Spark ML jobs."""

__version__ = "0.1.0"
