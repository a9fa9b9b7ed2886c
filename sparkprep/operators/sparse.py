"""Sparse feature rows whose dictionaries stay on the executors.

A dictionary (:func:`fit_levels`, :func:`number_terms`) is a table of stable
numbers, one row per level or term, which can be written and read like any
other. Rows are encoded by a join with it: one (key, index, value) entry per
value that isn't zero, folded to one row per key (:func:`fold`) and read as
Spark ML vectors (:func:`vectors`). The driver holds one count per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.operators.encode import level_codes
from sparkprep.operators.ordering import with_row_index
from sparkprep.session import materialize, shared_path


def _col(name: str):
    return F.col(f"`{name}`")


def fit_levels(df: DataFrame, cols: Sequence[str], first: int = 0) -> tuple[DataFrame, int]:
    """(column_name, level, index) of every distinct non-null value of ``cols``,
    and the index after the last. Columns follow each other; a column's levels are
    sorted by text. Any number of levels."""
    out = None
    for c in cols:
        codes = materialize(level_codes(df.select(_col(c).cast("string").alias("value")), "value"))
        one = codes.select(F.lit(c).alias("column_name"), "level", (F.col("code") - 1 + first).cast("int").alias("index"))
        out = one if out is None else out.unionByName(one)
        first += codes.count()
    return out, first


def number_terms(vocab: DataFrame, term: str = "term") -> tuple[DataFrame, int]:
    """(term, index) of a vocabulary, numbered in the order of its terms, and
    their count."""
    numbers = materialize(with_row_index(vocab.select(_col(term).alias("term")).distinct(), ["term"], "number"))
    return numbers.select("term", (F.col("number") - 1).cast("int").alias("index")), numbers.count()


def level_entries(df: DataFrame, key: str, numeric: Sequence[str], levels: DataFrame) -> DataFrame:
    """(key, index, value) of each row: the ``numeric`` columns at 0, 1, ... and a 1
    at the index of each of its levels. Nulls, zeros and levels that the dictionary
    doesn't hold have no entry; every key has one entry without an index."""
    cols = [r["column_name"] for r in levels.select("column_name").distinct().collect()]  # one per column
    held = [F.struct(F.lit(None).cast("int").alias("index"), F.lit(None).cast("double").alias("value"))]
    held += [F.struct(F.lit(i).alias("index"), _col(c).cast("double").alias("value")) for i, c in enumerate(numeric)]
    plain = df.select(_col(key).alias("key"), F.explode(F.array(*held)).alias("e")).select("key", "e.*")
    plain = plain.where("index IS NULL OR value <> 0")
    if not cols:
        return plain
    named = [F.struct(F.lit(c).alias("column_name"), _col(c).cast("string").alias("level")) for c in cols]
    melted = df.select(_col(key).alias("key"), F.explode(F.array(*named)).alias("e")).select("key", "e.*").where("level IS NOT NULL")
    coded = melted.join(levels, ["column_name", "level"]).select("key", "index", F.lit(1.0).alias("value"))
    return plain.unionByName(coded)


def term_entries(docs: DataFrame, key: str, counts: DataFrame, numbers: DataFrame) -> DataFrame:
    """(key, index, value) of long document-term counts (``key``, term, n); every
    document has one entry without an index, terms without a number have none."""
    plain = docs.select(_col(key).alias("key"), F.lit(None).cast("int").alias("index"), F.lit(None).cast("double").alias("value"))
    coded = counts.join(numbers, "term").select(_col(key).alias("key"), "index", F.col("n").cast("double").alias("value"))
    return plain.unionByName(coded)


def fold(entries: DataFrame) -> DataFrame:
    """One row per key: ``indices`` in ascending order and their ``values``.
    A key has at most as many entries as its row has features."""
    held = F.when(F.col("index").isNotNull(), F.struct("index", "value"))
    rows = entries.groupBy("key").agg(F.array_sort(F.collect_list(held)).alias("e"))
    return rows.select("key", F.col("e.index").alias("indices"), F.col("e.value").alias("values"))


def vectors(folded: DataFrame, size: int, name: str = "features") -> DataFrame:
    """(key, ``name``): sparse vectors of ``size``. They are written to the shared
    folder in the layout of Spark's vector type and read back as vectors, so no
    row passes through Python; a fit reads the table many times anyway."""
    spark = folded.sparkSession
    path = shared_path(spark, "vectors")
    folded.select("key", F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values").alias(name)).write.parquet(path)
    return spark.read.schema(T.StructType([folded.schema["key"], T.StructField(name, VectorUDT())])).parquet(path)
