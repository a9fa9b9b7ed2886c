"""Missing-value handling.

Statistics are fitted with one aggregate over all requested columns and then
applied as literals (like Spark ML's ``Imputer``): the plan stays a narrow
projection, and nothing row-level reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators.ordering import exact_quantiles


def fit_mean(df: DataFrame, cols: Iterable[str]) -> dict[str, float | None]:
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def fit_median(df: DataFrame, cols: Iterable[str], exact: bool = True,
               accuracy: int = 10000) -> dict[str, float | None]:
    """Median per column. ``exact`` uses distributed exact quantiles (sorted
    counts, never one task holding a column); otherwise percentile_approx."""
    cols = list(cols)
    if not cols:
        return {}
    if not exact:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy)
                       .alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    # all columns in one job: stack to (column, value), quantiles per column
    pairs = [x for i, c in enumerate(cols) for x in (F.lit(i), F.col(f"`{c}`").cast("double"))]
    long = df.select(F.stack(F.lit(len(cols)), *pairs).alias("__col", "__v"))
    got = {r["__col"]: r["q_0"] for r in exact_quantiles(long, "__v", [0.5], by=["__col"]).collect()}
    return {c: got.get(i) for i, c in enumerate(cols)}


def apply_fill(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls with the given literal per column; filled numeric columns
    become double, as a mean fill produces doubles."""
    exprs = {}
    for c, v in values.items():
        if v is None:
            continue
        if isinstance(v, float):
            exprs[c] = F.coalesce(F.col(c).cast("double"), F.lit(v))
        else:
            exprs[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(exprs)


def mean(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fill nulls with the column mean of the same table."""
    return apply_fill(df, fit_mean(df, cols))


def median(df: DataFrame, cols: Iterable[str], exact: bool = True) -> DataFrame:
    return apply_fill(df, {c: (float(v) if v is not None else None)
                           for c, v in fit_median(df, cols, exact).items()})


def const(df: DataFrame, values: dict) -> DataFrame:
    """Fill nulls with constants per column (text, number or date column)."""
    exprs = {}
    for c, v in values.items():
        lit = v if isinstance(v, Column) else F.lit(v)
        exprs[c] = F.coalesce(F.col(c), lit)
    return df.withColumns(exprs)


def group_first(df: DataFrame, col: str, by: str, order_col: str,
                out: str | None = None) -> DataFrame:
    """Fill nulls in ``col`` with the group's first non-null value in
    ``order_col`` order; an all-null group stays null; null keys form one group.

    One map-side-combined aggregate (min of ``(order, value)`` over non-null
    values) gives a row per group, joined back on the key (null-safe). A hot
    group costs nothing extra in the aggregate, and AQE broadcasts the
    per-group table when it is small or splits skewed partitions otherwise.
    """
    out = out or col
    firsts = (df.where(F.col(col).isNotNull())
              .groupBy(by)
              .agg(F.min(F.struct(F.col(order_col), F.col(col))).alias("__first"))
              .select(F.col(by).alias("__gkey"), F.col(f"__first.{col}").alias("__fill")))
    joined = df.join(firsts, df[by].eqNullSafe(firsts["__gkey"]), "left")
    return (joined.withColumn(out, F.coalesce(F.col(col), F.col("__fill")))
            .drop("__gkey", "__fill"))


def flag_levels(df: DataFrame, cols: Iterable[str],
                level: str = fv.NOT_MENTIONED) -> DataFrame:
    """0/1 flags become text levels "0"/"1" with nulls as ``level``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(level))
                           for c in cols})


def fill_tokens(col, token: str = fv.MISSING_TOKEN) -> Column:
    """Null list elements -> ``token``; a null list -> ``[token]``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.transform(c, lambda x: F.coalesce(x, F.lit(token))),
                      F.array(F.lit(token)))
