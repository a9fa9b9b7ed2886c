"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A text table restricted to ``cols``. The number of scan tasks follows
    from the session's split settings; rows are not moved."""
    df = table(spark, sf_dir, name)
    return df.select(*cols) if cols else df
