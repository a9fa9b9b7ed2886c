"""Category-level drift between two tables (e.g. train vs test)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column_name, level) pairs of all categorical columns, from
    one unpivot (stack) and one distinct."""
    pairs = [x for c in cols for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    return (df.select(F.stack(F.lit(len(cols)), *pairs).alias("column_name", "level"))
            .where(F.col("level").isNotNull()).distinct())


def levels(train: DataFrame, test: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, level, side) for levels present on one side only
    (side = 'train_only' / 'test_only'), over every shared string column
    unless ``cols`` is given."""
    if cols is None:
        tt = dict(test.dtypes)
        cols = [c for c, t in train.dtypes if t == "string" and tt.get(c) == "string"]
    a, b = _levels(train, cols), _levels(test, cols)
    on = ["column_name", "level"]
    only_a = a.join(b, on, "left_anti").withColumn("side", F.lit("train_only"))
    only_b = b.join(a, on, "left_anti").withColumn("side", F.lit("test_only"))
    return only_a.unionByName(only_b)


def verdict(train: DataFrame, test: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_train_only, n_test_only, verdict) for every shared
    string column (or ``cols``): 'different' when any level is one-sided, else
    'identical'."""
    if cols is None:
        tt = dict(test.dtypes)
        cols = [c for c, t in train.dtypes if t == "string" and tt.get(c) == "string"]
    every = train.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    counts = levels(train, test, cols).groupBy("column_name").agg(
        F.count_if(F.col("side") == "train_only").alias("n_train_only"),
        F.count_if(F.col("side") == "test_only").alias("n_test_only"))
    out = every.join(counts, "column_name", "left").na.fill(0, ["n_train_only", "n_test_only"])
    one_sided = F.col("n_train_only") + F.col("n_test_only") > 0
    return out.withColumn("verdict", F.when(one_sided, "different").otherwise("identical"))
