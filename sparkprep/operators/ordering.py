"""Order-dependent building blocks without a single-partition window.

Spark rows have no order, while the original workflow relies on row positions
(positional binds, first row per key, contiguous folds, exact-size samples,
exact medians). All of these reduce to a *prefix sum in a total order*:

1. the first order column is cut into ``B`` ranges at approximate quantiles
   (one bounded ``percentile_approx`` aggregate, collected as ``B-1`` numbers);
2. one aggregate counts (or sums weights of) rows per ``(group, range)``; a
   window over that small table gives each range its offset within the group;
3. a window partitioned by ``(group, range)`` and ordered by the full order
   key adds the position inside the range.

No step puts a whole group, let alone the whole table, into one task: a hot
group is split across the ``B`` ranges, and the only un-partitioned window
runs over at most ``B`` rows. The first order column must be numeric (or
castable to double in an order-preserving way) and should be close to unique;
later columns break ties. Row indexes by text keys go by range partitions over
all order columns instead (:func:`with_row_index`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.session import materialize, shuffle_partitions

_KEY = "__ord_key"
_BKT = "__ord_bucket"
_W = "__ord_w"
_BW = "__ord_bucket_w"
_OFF = "__ord_offset"
_TOT = "__ord_total"


def _as_cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _names(cols) -> list[str]:
    if isinstance(cols, str):
        return [cols]
    return list(cols or [])


def default_buckets(df: DataFrame) -> int:
    """Four ranges per shuffle partition (so per-range windows shrink as the
    cluster's shuffle width, which is set for the data, grows)."""
    return max(8, 4 * shuffle_partitions(df.sparkSession))


def range_splits(df: DataFrame, key: Column, n_buckets: int,
                 accuracy: int | None = None) -> list[float]:
    """Bucket edges at approximate quantiles of ``key`` (bounded memory). The
    sketch accuracy scales with the number of ranges so neighbouring edges
    stay distinguishable."""
    accuracy = accuracy or max(10_000, 4 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.select(F.percentile_approx(key.cast("double"), probs, accuracy)
                    .alias("q")).first()
    qs = (row["q"] if row is not None else None) or []
    inner = sorted({q for q in qs if q is not None and not math.isnan(q)
                    and not math.isinf(q)})
    return [-math.inf, *inner, math.inf]


def _bucketize(df: DataFrame, first: Column, n_buckets: int,
               key_range: tuple[float, float] | None = None) -> DataFrame:
    if key_range is not None:
        # Uniformly distributed key (e.g. a hash prefix): equal-width ranges
        # are already balanced, so no quantile pass over the data is needed.
        lo, hi = key_range
        width = (hi - lo) / n_buckets
        b = F.floor((first.cast("double") - F.lit(float(lo))) / F.lit(width))
        b = F.coalesce(F.least(F.greatest(b, F.lit(0)), F.lit(n_buckets - 1)).cast("int"), F.lit(-1))
        return df.withColumn(_BKT, b)
    keyed = df.withColumn(_KEY, first.cast("double"))
    splits = range_splits(keyed, F.col(_KEY), n_buckets)
    if len(splits) < 3:
        return keyed.withColumn(_BKT, F.lit(0)).drop(_KEY)
    bk = Bucketizer(splits=splits, inputCol=_KEY, outputCol=_BKT,
                    handleInvalid="keep")
    # Non-null bucket (keys are non-null) so joins infer no extra filter that
    # would recompute the key expression.
    return (bk.transform(keyed)
            .withColumn(_BKT, F.coalesce(F.col(_BKT).cast("int"), F.lit(-1))).drop(_KEY))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                    small: bool) -> DataFrame:
    ren = {k: f"__r_{k}" for k in keys if k != _BKT}
    r = right
    for k, v in ren.items():
        r = r.withColumnRenamed(k, v)
    r = r.withColumnRenamed(_BKT, "__r_bkt")
    cond = [left[_BKT] == r["__r_bkt"]]
    cond += [left[k].eqNullSafe(r[v]) for k, v in ren.items()]
    if small:
        r = F.broadcast(r)
    out = left.join(r, cond, "inner")
    return out.drop("__r_bkt", *ren.values())


def prefix_sums(df: DataFrame, order_cols, by: Sequence[str] = (),
                weight: str | Column | None = None,
                before: str = "_before", total: str | None = None,
                n_buckets: int | None = None,
                key_range: tuple[float, float] | None = None) -> DataFrame:
    """Add ``before`` = sum of ``weight`` (default 1) over rows that come
    earlier in ``order_cols`` within the same ``by`` group, and optionally
    ``total`` = the group's full sum. Ties in ``order_cols`` are broken
    arbitrarily, so pass a unique order for positional use. ``key_range``
    declares the first order key uniform on ``[lo, hi)`` (hash values).
    """
    order = _as_cols(order_cols)
    by = _names(by)
    b = n_buckets or default_buckets(df)
    w = F.lit(1).cast("long") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight)
    data = _bucketize(df.withColumn(_W, w), order[0], b, key_range)

    per = data.groupBy(*by, _BKT).agg(F.sum(_W).alias(_BW))
    wgrp = Window.partitionBy(*by) if by else Window.partitionBy()
    offs = per.withColumn(
        _OFF, F.coalesce(F.sum(_BW).over(
            wgrp.orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
    if total:
        offs = offs.withColumn(_TOT, F.sum(_BW).over(wgrp))
    offs = offs.drop(_BW)
    # Without groups the offsets table has at most ``b`` rows: safe to broadcast.
    joined = _null_safe_join(data, offs, [*by, _BKT], small=not by)

    inner = Window.partitionBy(*by, _BKT).orderBy(*order)
    if weight is None:
        pos = F.row_number().over(inner) - 1
    else:
        pos = F.coalesce(F.sum(_W).over(
            inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = joined.withColumn(before, F.col(_OFF) + pos)
    if total:
        out = out.withColumnRenamed(_TOT, total)
    return out.drop(_OFF, _BKT, _W)


def with_row_index(df: DataFrame, order_cols, name: str = "row_idx",
                   by: Sequence[str] = (), start: int = 1,
                   total: str | None = None,
                   n_buckets: int | None = None,
                   key_range: tuple[float, float] | None = None) -> DataFrame:
    """Dense position (``start``-based) of each row in ``order_cols`` order,
    optionally restarting per ``by`` group. ``order_cols`` must be unique
    (within a group) for the result to be deterministic."""
    first = df.select(_as_cols(order_cols)[0]).schema[0].dataType
    if isinstance(first, (T.StringType, T.BinaryType)):
        return _index_by_ranges(df, order_cols, name, _names(by), start, total)
    out = prefix_sums(df, order_cols, by=by, before="__pos", total=total,
                      n_buckets=n_buckets, key_range=key_range)
    return out.withColumn(name, F.col("__pos") + F.lit(start)).drop("__pos")


def _index_by_ranges(df: DataFrame, order_cols, name: str, by: list[str], start: int,
                     total: str | None) -> DataFrame:
    """Row index for keys that have no number: rows are range-partitioned and
    sorted by all group and order columns (equal first values spread over
    ranges), written to the shared folder once, and numbered from one count
    per partition. Within groups the group's smallest position is taken off."""
    order = [F.col(f"`{c}`") for c in by] + _as_cols(order_cols)
    ranged = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    rows = materialize(ranged.withColumn(_KEY, F.monotonically_increasing_id()))
    part = F.shiftright(_KEY, 33)  # the high bits of the id number the partition
    counts = rows.groupBy(part.alias(_BKT)).agg(F.count(F.lit(1)).alias(_W))
    before = F.coalesce(F.sum(_W).over(Window.orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per partition.
    offs = counts.select(_BKT, before.alias(_OFF), F.sum(_W).over(Window.partitionBy()).alias(_TOT))
    place = F.col(_KEY) - F.shiftleft(F.col(_BKT), 33) + F.col(_OFF)
    out = rows.withColumn(_BKT, part).join(F.broadcast(offs), _BKT).withColumn(name, place)
    if by:
        groups = out.groupBy(*[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(by)]).agg(F.min(name).alias(_BW), F.count(F.lit(1)).alias(_W))
        cond = F.lit(True)
        for i, c in enumerate(by):
            cond = cond & F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}"))
        out = out.drop(_TOT).join(groups.withColumnRenamed(_W, _TOT), cond).withColumn(name, F.col(name) - F.col(_BW))
        out = out.drop(_BW, *[f"__g{i}" for i in range(len(by))])
    out = out.withColumn(name, F.col(name) + F.lit(start))
    out = out.withColumnRenamed(_TOT, total) if total else out.drop(_TOT)
    return out.drop(_KEY, _BKT, _OFF)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (),
                 name: str = "__c") -> DataFrame:
    """(group, value, count) of non-null values, map-side combined."""
    return (df.where(F.col(value).isNotNull())
            .groupBy(*_names(by), value).agg(F.count(F.lit(1)).alias(name)))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), prefix: str = "q",
                    count_col: str | None = None) -> DataFrame:
    """Exact type-7 (linear interpolation) quantiles of ``value`` per group.

    Values are first reduced to ``(group, value, count)`` (map-side combined,
    so hot groups and repeated values cost little), then positioned with
    :func:`prefix_sums`. Pass ``count_col`` when ``df`` already is such a
    table. Returns one row per group with columns
    ``{prefix}_0 .. {prefix}_{k-1}`` and ``n`` (non-null count).
    """
    by = _names(by)
    if count_col is None:
        vals = value_counts(df, value, by)
    else:
        vals = df.withColumnRenamed(count_col, "__c")
    cum = prefix_sums(vals, [value], by=by, weight="__c", before="__b",
                      total="__n")
    targets = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(float(p))
        targets.append(F.struct(F.lit(i).alias("i"), F.lit(0).alias("hi"),
                                F.floor(h).alias("t"), h.alias("h")))
        targets.append(F.struct(F.lit(i).alias("i"), F.lit(1).alias("hi"),
                                F.ceil(h).alias("t"), h.alias("h")))
    covered = F.filter(F.array(*targets),
                       lambda x: (x["t"] >= F.col("__b"))
                       & (x["t"] < F.col("__b") + F.col("__c")))
    hits = (cum.select(*by, value, "__n", F.explode(covered).alias("__x"))
            .select(*by, "__n", F.col("__x.i").alias("__i"),
                    F.col("__x.hi").alias("__hi"), F.col("__x.h").alias("__h"),
                    F.col(value).cast("double").alias("__v")))
    per_p = (hits.groupBy(*by, "__i")
             .agg(F.max(F.when(F.col("__hi") == 0, F.col("__v"))).alias("__lo_v"),
                  F.max(F.when(F.col("__hi") == 1, F.col("__v"))).alias("__hi_v"),
                  F.max("__h").alias("__h"), F.max("__n").alias("n"))
             .withColumn("__q", F.col("__lo_v") + (F.col("__h") - F.floor("__h"))
                         * (F.col("__hi_v") - F.col("__lo_v"))))
    aggs = [F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"{prefix}_{i}")
            for i in range(len(probs))]
    return per_p.groupBy(*by).agg(*aggs, F.max("n").alias("n"))
