"""Reproducible splits: exact-size hashed hold-out, nested hold-out,
independent fractional subsets and contiguous folds.

Rows are ranked by ``md5(seed:key)`` (then the key), which is independent of
partitioning and file layout, unlike ``randomSplit``. Split sizes are exact
(``floor(frac * n)``): the pair at the split is found among the rows of one
hash bucket, and every row is compared with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators.ordering import with_row_index


def hash_text(seed, key: str, salt: Column | None = None) -> Column:
    parts = [F.lit(f"{seed}:")]
    if salt is not None:
        parts += [salt.cast("string"), F.lit(":")]
    # a null key hashes like an empty key: every row keeps a hash and a bucket
    parts.append(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


BUCKETS = 4096


def _limits(df: DataFrame, frac, seed, key: str, by: list[str], salt, n_buckets: int, few: bool = False) -> DataFrame:
    """Per group the ``(hash, key)`` of the last row that is taken, from scans
    of the key and group columns alone.

    Hashes are uniform, so the hash's first digits cut the rows into even
    buckets. A count per (group, bucket) tells the bucket that holds the limit;
    of that bucket, 1/``n_buckets`` of a group, the pairs are ranked."""
    names = [F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(by)]
    g = [f"__g{i}" for i in range(len(by))]
    pairs = df.select(*names, frac.alias("__f"), hash_text(seed, key, salt).alias("__h"), F.col(f"`{key}`").alias("__key"))
    bucket = F.floor(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * F.lit(n_buckets) / F.lit(16 ** 8)).cast("int")
    pairs = pairs.withColumn("__b", bucket)
    per = pairs.groupBy(*g, "__b").agg(F.count(F.lit(1)).alias("__c"), F.max("__f").alias("__f"))
    grp = Window.partitionBy(*g) if g else Window.partitionBy()
    before = F.coalesce(F.sum("__c").over(grp.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    take = F.floor(F.sum("__c").over(grp) * F.max("__f").over(grp))
    edge = (per.select(*g, "__b", "__c", before.alias("__before"), take.alias("__take"))
            .filter((F.col("__take") > F.col("__before")) & (F.col("__take") <= F.col("__before") + F.col("__c")))
            .select(*[F.col(c).alias(c + "e") for c in g], F.col("__b").alias("__be"), (F.col("__take") - F.col("__before")).alias("__need")))
    # At most one row per group; one row without groups.
    same = [F.col("__b") == F.col("__be"), *(F.col(c).eqNullSafe(F.col(c + "e")) for c in g)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    near = pairs.join(F.broadcast(edge) if few or not g else edge, cond)
    rank = F.row_number().over(Window.partitionBy(*g, "__b").orderBy("__h", "__key"))
    return (near.withColumn("__r", rank).filter(F.col("__r") == F.col("__need"))
            .select(*g, F.struct(F.col("__h"), F.col("__key")).alias("__limit")))


def hash_select(df: DataFrame, frac, seed, key: str, flag: str, by=(), salt=None,
                n_buckets: int = BUCKETS, few: bool = False) -> DataFrame:
    """``flag`` = row is among the ``floor(frac * n)`` lowest ``(hash, key)``
    of its ``by`` group (``frac`` a number or a column). A null group is a
    group like any other.

    The k-th lowest pair is found first (:func:`_limits`, which reads only key
    and group columns); then each row is compared with it. Without groups the
    limit is a scalar, so the table itself is scanned once and never joined or
    shuffled. ``few`` says that the caller names the groups: their limits are then
    broadcast and no row is shuffled."""
    by = [by] if isinstance(by, str) else list(by)
    fr = frac if isinstance(frac, Column) else F.lit(float(frac))
    limits = _limits(df, fr, seed, key, by, salt, n_buckets, few)
    pair = F.struct(hash_text(seed, key, salt).alias("__h"), F.col(f"`{key}`").alias("__key"))
    if not by:
        return df.withColumn(flag, F.coalesce(pair <= limits.select("__limit").scalar(), F.lit(False)))
    cond = None
    for i, c in enumerate(by):
        one = F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}"))
        cond = one if cond is None else cond & one
    # One row per group; what Spark broadcasts or shuffles follows from its size.
    out = df.join(F.broadcast(limits) if few else limits, cond, "left").withColumn(flag, F.coalesce(pair <= F.col("__limit"), F.lit(False)))
    return out.drop("__limit", *[f"__g{i}" for i in range(len(by))])


def holdout(df: DataFrame, frac: float, seed, key: str,
            flag: str = "is_holdout") -> DataFrame:
    """``flag`` is true for exactly ``floor(frac * n)`` rows (the lowest
    hashes); the complement is ``~flag`` (no anti-join needed)."""
    return hash_select(df, frac, seed, key, flag)


def nested_holdout(df: DataFrame, key: str, seed=fv.SPLIT_SEED,
                   valid_frac: float = fv.VALID_FRACTION,
                   final_frac: float = fv.FINAL_FRACTION,
                   out: str = "split") -> DataFrame:
    """train / valid_use / valid_final: ``valid_frac`` of rows go to
    validation, of which ``final_frac`` is set aside."""
    first = holdout(df, valid_frac, seed, key, "__valid")
    inner = _limits(first.where("__valid"), F.lit(float(final_frac)), f"{seed}/2", key, [], None, BUCKETS)
    pair = F.struct(hash_text(f"{seed}/2", key).alias("__h"), F.col(f"`{key}`").alias("__key"))
    final = F.coalesce(pair <= inner.select("__limit").scalar(), F.lit(False))
    return first.withColumn(out, F.when(~F.col("__valid"), "train").when(final, "valid_final").otherwise("valid_use")).drop("__valid")


def fractions(df: DataFrame, fracs: Sequence[float], seed, key: str,
              name: str = "fraction") -> DataFrame:
    """For each fraction f an independent hashed subset of ``floor(f * n)``
    rows; all subsets are produced by one job (rows tagged with f)."""
    arr = F.array(*[F.lit(float(f)) for f in fracs])
    tagged = df.withColumn(name, F.explode(arr))
    sel = hash_select(tagged, F.col(name), seed, key, "__sel", by=[name], salt=F.col(name), few=True)
    return sel.where("__sel").drop("__sel")


def contiguous_folds(df: DataFrame, k: int, order_col: str,
                     out: str = "fold") -> DataFrame:
    """k equal-width folds over the 1-based row position i of n, as
    ``cut(seq(1, n), k)``: fold = max(1, ceil((i - 1) * k / (n - 1)))."""
    ranked = with_row_index(df, [order_col], "__i", total="__n")
    frac = F.try_divide((F.col("__i") - 1) * F.lit(k), (F.col("__n") - 1).cast("double"))
    return (ranked.withColumn(out, F.greatest(F.lit(1), F.ceil(frac).cast("int")))
            .drop("__i", "__n"))
