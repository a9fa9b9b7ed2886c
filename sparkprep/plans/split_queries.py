"""Hold-out splits, training fractions and contiguous folds on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators import split
from sparkprep.plans.registry import query
from sparkprep.sources.tables import table

SEED = fv.SPLIT_SEED


def _rank_sql(seed, frac_col: str | None = None) -> str:
    salt = f" || CAST({frac_col} AS VARCHAR) || ':'" if frac_col else ""
    part = f"PARTITION BY {frac_col} " if frac_col else ""
    return (f"row_number() OVER ({part}ORDER BY md5('{seed}:'{salt} || CAST(o_orderkey AS VARCHAR)), "
            f"o_orderkey)")


@query("holdout_split", f"""
SELECT o_orderkey, rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE) AS is_valid
FROM (SELECT o_orderkey, {_rank_sql(SEED)} AS rn, count(*) OVER () AS cnt FROM orders) t""")
def holdout_split(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return split.holdout(o, fv.VALID_FRACTION, SEED, "o_orderkey", "is_valid")


@query("nested_holdout", f"""
WITH a AS (SELECT o_orderkey, {_rank_sql(SEED)} AS rn, count(*) OVER () AS cnt FROM orders),
v AS (SELECT o_orderkey FROM a WHERE rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE)),
b AS (SELECT o_orderkey, {_rank_sql(f'{SEED}/2')} AS rn, count(*) OVER () AS cnt FROM v)
SELECT o_orderkey, 'train' AS split FROM a WHERE rn > floor(cnt * {fv.VALID_FRACTION}::DOUBLE)
UNION ALL
SELECT o_orderkey, CASE WHEN rn <= floor(cnt * {fv.FINAL_FRACTION}::DOUBLE) THEN 'valid_final'
                        ELSE 'valid_use' END AS split FROM b""")
def nested_holdout(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return split.nested_holdout(o, "o_orderkey", SEED)


_FRACS = ", ".join(f"({f}::DOUBLE)" for f in fv.TRAIN_SIZES)


@query("train_fractions", f"""
WITH f(fraction) AS (VALUES {_FRACS}),
x AS (SELECT fraction, o_orderkey, o_totalprice FROM f, orders),
r AS (SELECT fraction, o_orderkey, o_totalprice, {_rank_sql(SEED, 'fraction')} AS rn,
             count(*) OVER (PARTITION BY fraction) AS cnt FROM x)
SELECT fraction, CAST(count(*) AS BIGINT) AS n_rows, round(sum(o_totalprice), 2) AS total_price,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM r WHERE rn <= floor(cnt * fraction) GROUP BY fraction""")
def train_fractions(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    subsets = split.fractions(o, fv.TRAIN_SIZES, SEED, "o_orderkey")
    return subsets.groupBy("fraction").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.sum("o_orderkey").alias("key_sum"))


@query("contiguous_folds", f"""
SELECT o_orderkey,
  CAST(greatest(1, ceil((rn - 1) * {fv.CV_FOLDS} / (cnt - 1)::DOUBLE)) AS INTEGER) AS fold
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS cnt
      FROM orders) t""")
def contiguous_folds(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return split.contiguous_folds(o, fv.CV_FOLDS, "o_orderkey")
