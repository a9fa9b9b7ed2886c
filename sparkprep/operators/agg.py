"""Grouped counts, top-n with ties, top-k rows, contingency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n",
             sort: bool = False) -> DataFrame:
    """Rows per key combination (null keys form their own group)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if sort:
        out = out.orderBy(F.desc(name), *keys)
    return out


def top_n_with_ties(counts: DataFrame, n: int, by: str) -> DataFrame:
    """Rows whose ``by`` ranks within the top ``n`` (ties kept, like rank()<=n).

    rank(x) <= n  <=>  x >= the n-th largest value. That value comes from a
    distributed top-n (TakeOrdered, n rows per task) as a scalar subquery, so
    no window sorts the whole table in one partition."""
    nth = counts.orderBy(F.desc(by)).limit(n).agg(F.min(by)).scalar()
    return counts.where(F.col(by) >= nth)


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """First ``k`` rows in ``order`` (ties cut), computed as TakeOrdered."""
    return df.orderBy(*order).limit(k)


def lump(df: DataFrame, col: str, keep: DataFrame, other: str = "Other",
         out: str | None = None) -> DataFrame:
    """Values of ``col`` not in ``keep[col]`` become ``other``."""
    k = keep.select(F.col(col).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    j = df.join(k, df[col] == k["__k"], "left")
    return (j.withColumn(out or col, F.when(F.col("__hit"), F.col(col))
                         .otherwise(F.lit(other))).drop("__k", "__hit"))


def crosstab(df: DataFrame, row: str, col: str, levels: Sequence[str],
             name_fmt: str = "{}") -> DataFrame:
    """Wide contingency table with fixed column levels (missing cells -> 0)."""
    return (df.groupBy(row).pivot(col, list(levels)).agg(F.count(F.lit(1)))
            .fillna(0, subset=list(levels))
            .withColumnsRenamed({lv: name_fmt.format(lv) for lv in levels}))
