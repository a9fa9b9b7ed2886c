"""Exploratory summary tables (the data behind each chart): null profiles,
histograms, box-plot statistics, 2-D bin densities and frequency weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators.ordering import exact_quantiles, value_counts
from sparkprep.session import materialize


def numeric_summary(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, n, mean, sd, min, max) for numeric columns, from ONE
    aggregate over all of them, unpivoted to long form."""
    from pyspark.sql import types as T
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [x for i, c in enumerate(cols) for x in (F.lit(c), *(F.col(f"{k}{i}") for k in ("n", "m", "s", "lo", "hi")))]
    return wide.select(F.stack(F.lit(len(cols)), *rows).alias("column_name", "n", "mean", "sd", "min", "max"))


def full_summary(df: DataFrame, cols=None) -> DataFrame:
    """:func:`numeric_summary` with the null count and exact quartiles."""
    from pyspark.sql import types as T
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    pairs = [x for c in cols for x in (F.lit(c), F.col(f"`{c}`").cast("double"))]
    long = df.select(F.stack(F.lit(len(cols)), *pairs).alias("column_name", "__v"))
    q = exact_quantiles(long, "__v", [0.25, 0.5, 0.75], by=["column_name"]).drop("n")
    q = q.toDF("column_name", "q1", "median", "q3")
    return (numeric_summary(df, cols).withColumn("n", F.col("n").cast("long"))
            .join(nulls(df.select(*[F.col(f"`{c}`") for c in cols]), only_missing=False).select("column_name", "n_null"), "column_name")
            .join(q, "column_name", "left"))


def level_counts(df: DataFrame, cols=None, top: int = 6) -> DataFrame:
    """(column_name, level, n) for text columns: the ``top`` most frequent levels, by
    count and then by MD5 of the level, and the sum of all others as ``(Other)``.

    Two scans. The first counts 16-byte digests, never the texts, so columns of long
    or distinct texts shuffle no text; their top digests (``top`` rows a column) are
    the only ones whose texts the second scan looks up. Nulls are no level."""
    from pyspark.sql import types as T
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, level string, n long")
    pairs = [x for c in cols for x in (F.lit(c), F.col(f"`{c}`"))]
    long = df.select(F.stack(F.lit(len(cols)), *pairs).alias("column_name", "level")).where("level IS NOT NULL")
    long = long.withColumn("key", F.md5(F.col("level").cast("binary")))
    counts = long.groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("n"))
    # A column's top levels are among those of its parts: a bounded heap per part, so
    # a column of many levels is no single window.
    spread = counts.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(64)))
    order = [F.desc("n"), F.asc("key")]
    heads = spread.withColumn("r", F.row_number().over(Window.partitionBy("column_name", "part").orderBy(*order))).where(F.col("r") <= top)
    heads = heads.withColumn("r", F.row_number().over(Window.partitionBy("column_name").orderBy(*order))).where(F.col("r") <= top)
    heads = materialize(heads.select("column_name", "key", "n"))
    # ``top`` rows a column.
    named = (long.join(F.broadcast(heads.select("column_name", "key")), ["column_name", "key"])
             .groupBy("column_name", "key").agg(F.min("level").alias("level")))
    shown = heads.join(named, ["column_name", "key"]).select("column_name", "level", "n")
    rest = (counts.groupBy("column_name").agg(F.sum("n").alias("n"))
            .join(heads.groupBy("column_name").agg(F.sum("n").alias("taken")), "column_name")
            .select("column_name", F.lit("(Other)").alias("level"), (F.col("n") - F.col("taken")).alias("n")).where("n > 0"))
    return shown.unionByName(rest)


def nulls(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """(column_name, n_null, n_not_null) from ONE aggregate over all columns,
    unpivoted to long form."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = [x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"__n{i}"))]
    long = wide.select("__rows", F.stack(F.lit(len(cols)), *pairs).alias("column_name", "n_null"))
    out = long.select("column_name", F.col("n_null").cast("long").alias("n_null"),
                      (F.col("__rows") - F.col("n_null")).cast("long").alias("n_not_null"))
    return out.where(F.col("n_null") > 0) if only_missing else out


def null_split(df: DataFrame, col: str, sentinel: str | None = None) -> DataFrame:
    """Counts of null vs non-null (or sentinel vs other) values of ``col``."""
    c = F.col(col)
    cond = c.isNull() if sentinel is None else (c == F.lit(sentinel))
    label = F.when(cond, F.lit("NA" if sentinel is None else sentinel)) \
        .otherwise(F.lit("Non-NA" if sentinel is None else "Other"))
    return df.groupBy(label.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def _bounds(df: DataFrame, x: Column, lo, hi):
    if lo is None or hi is None:
        ext = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
        lo = ext.select("lo").scalar() if lo is None else F.lit(lo)
        hi = ext.select("hi").scalar() if hi is None else F.lit(hi)
    else:
        lo, hi = F.lit(lo), F.lit(hi)
    return lo, hi


def bin_index(x: Column, lo, hi, bins: int) -> Column:
    """Equal-width bin of x in [lo, hi]; the right edge goes to the last bin
    and a constant column (zero width) falls in bin 0."""
    w = (hi - lo) / F.lit(bins)
    b = F.coalesce(F.floor(F.try_divide(x - lo, w)), F.lit(0))
    return F.least(b, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col, bins: int = fv.HIST_BREAKS, lo=None, hi=None,
              name: str = "bin") -> DataFrame:
    """Counts per equal-width bin; bounds default to the data extent
    (computed as scalar subqueries, so the plan stays one job)."""
    x = F.col(col) if isinstance(col, str) else col
    lo_c, hi_c = _bounds(df, x, lo, hi)
    return (df.where(x.isNotNull())
            .groupBy(bin_index(x, lo_c, hi_c, bins).alias(name))
            .agg(F.count(F.lit(1)).alias("n")))


def bin2d(df: DataFrame, x: str, y: str, bins: int = fv.BIN2D_BINS,
          bounds: Sequence[float] | None = None) -> DataFrame:
    """2-D bin counts; ``bounds`` = (x_lo, x_hi, y_lo, y_hi) also filters rows
    outside the window (axis limits drop them)."""
    xc, yc = F.col(x), F.col(y)
    data = df.where(xc.isNotNull() & yc.isNotNull())
    if bounds is not None:
        x_lo, x_hi, y_lo, y_hi = bounds
        data = bbox(data, x, y, bounds)
        xl, xh, yl, yh = F.lit(x_lo), F.lit(x_hi), F.lit(y_lo), F.lit(y_hi)
    else:
        xl, xh = _bounds(data, xc, None, None)
        yl, yh = _bounds(data, yc, None, None)
    return (data.groupBy(bin_index(xc, xl, xh, bins).alias("bx"),
                         bin_index(yc, yl, yh, bins).alias("by"))
            .agg(F.count(F.lit(1)).alias("n")))


def bbox(df: DataFrame, x: str, y: str,
         bounds: Sequence[float] = fv.BAY_AREA_BOUNDS) -> DataFrame:
    """Rows with x in [x_lo, x_hi] and y in [y_lo, y_hi] (pushed into the scan)."""
    x_lo, x_hi, y_lo, y_hi = bounds
    return df.where(F.col(x).between(x_lo, x_hi) & F.col(y).between(y_lo, y_hi))


def boxplot(df: DataFrame, by: str, col: str, coef: float = 1.5,
            exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Q1, median, Q3 (linear interpolation), whisker ends (most extreme
    values within ``coef`` IQR of the box) and outlier count per group.
    Quartiles come from distributed exact quantiles, or with ``exact=False``
    from one ``percentile_approx`` aggregate (a bounded sketch per group,
    rank error about 1/accuracy); the fences are joined back (one row per
    group) for a single pass that finds whiskers."""
    # Both the quartiles and the whiskers work on (group, value, count):
    # repeated values and hot groups are reduced before any shuffle.
    vals = value_counts(df, col, [by], "__cnt")
    if exact:
        qs = exact_quantiles(vals, col, [0.25, 0.5, 0.75], by=[by], count_col="__cnt")
    else:
        q = F.percentile_approx(F.col(col).cast("double"), [0.25, 0.5, 0.75], accuracy)
        qs = (df.where(F.col(col).isNotNull()).groupBy(by)
              .agg(q.alias("__q"), F.count(F.lit(1)).alias("n"))
              .select(by, *[F.col("__q")[i].alias(f"q_{i}") for i in range(3)], "n"))
    qs = qs.select(
        F.col(by).alias("__g"), F.col("q_0").alias("q1"), F.col("q_1").alias("median"),
        F.col("q_2").alias("q3"), F.col("n"))
    qs = qs.withColumns({"__lo": F.col("q1") - coef * (F.col("q3") - F.col("q1")),
                         "__hi": F.col("q3") + coef * (F.col("q3") - F.col("q1"))})
    x = F.col(col)
    j = vals.join(qs, vals[by].eqNullSafe(qs["__g"]))
    inside = (x >= F.col("__lo")) & (x <= F.col("__hi"))
    return (j.groupBy(by, "q1", "median", "q3", "n")
            .agg(F.min(F.when(inside, x)).alias("whisker_lo"),
                 F.max(F.when(inside, x)).alias("whisker_hi"),
                 F.sum(F.when(~inside, F.col("__cnt")).otherwise(0)).alias("n_outliers")))


def weights(df: DataFrame, col: str, damp: str = "sqrt") -> DataFrame:
    """Category frequencies and damped weights (word-cloud sizes)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = F.sqrt("n") if damp == "sqrt" else F.log1p("n")
    return counts.withColumn("weight", w)
