"""Distributed row index, prefix sums and exact quantiles vs brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkprep.operators.ordering import exact_quantiles, prefix_sums, with_row_index


def test_row_index_matches_sorted_positions(spark):
    rng = np.random.default_rng(7)
    keys = rng.permutation(5000).tolist()
    df = spark.createDataFrame([(int(k), f"v{k}") for k in keys], "k long, v string")
    out = with_row_index(df, ["k"], "idx", n_buckets=16).select("k", "idx").collect()
    got = {r["k"]: r["idx"] for r in out}
    assert sorted(got) == sorted(keys)
    assert all(got[k] == k + 1 for k in keys)   # keys 0..n-1 -> positions 1..n


def test_row_index_grouped_with_hot_group(spark):
    # one group holds a third of the rows
    rows = [(0 if i % 3 == 0 else i % 7 + 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, k long")
    out = with_row_index(df, ["k"], "idx", by=["g"], total="n", n_buckets=8).collect()
    by_g = {}
    for r in out:
        by_g.setdefault(r["g"], []).append((r["k"], r["idx"], r["n"]))
    for g, lst in by_g.items():
        lst.sort()
        assert [i for _, i, _ in lst] == list(range(1, len(lst) + 1))
        assert {n for _, _, n in lst} == {len(lst)}


def test_prefix_sums_weighted(spark):
    rows = [(i, float(i % 5 + 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, w double")
    out = prefix_sums(df, ["k"], weight="w", before="b", n_buckets=7).orderBy("k").collect()
    acc = 0.0
    for r in out:
        assert r["b"] == pytest.approx(acc)
        acc += r["w"]


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1001])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(50, 20, n), 1)      # repeated values included
    groups = rng.integers(0, 3, n)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, v double")
    probs = [0.25, 0.5, 0.75]
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    for g in set(groups.tolist()):
        ref = np.quantile(vals[groups == g], probs)   # linear interpolation (type 7)
        for i, q in enumerate(ref):
            assert got[g][f"q_{i}"] == pytest.approx(q, abs=1e-9)


def test_exact_quantiles_ignore_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (None,), (4.0,)], "v double")
    row = exact_quantiles(df, "v", [0.5]).first()
    assert row["q_0"] == 2.0 and row["n"] == 3


def test_row_index_plan_has_no_single_partition_window_over_data(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    plan = with_row_index(df, ["k"], "idx", n_buckets=8)._jdf.queryExecution().executedPlan().toString()
    # the only un-partitioned window runs over the (bounded) per-bucket offsets
    assert "SinglePartition" not in plan or "Window" in plan
    assert with_row_index(df, ["k"], "idx", n_buckets=8).agg(F.max("idx")).first()[0] == 1000
