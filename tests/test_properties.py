"""Property tests (small example counts: every example runs Spark jobs)."""

import math

import pytest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkprep.operators import evaluate, impute, split
from sparkprep.operators.ordering import with_row_index

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(keys=st.sets(st.integers(-10**12, 10**12), min_size=1, max_size=300))
def test_row_index_is_sorted_rank(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["i"] for r in with_row_index(df, ["k"], "i", n_buckets=6).collect()}
    assert [got[k] for k in sorted(keys)] == list(range(1, len(keys) + 1))


@SETTINGS
@given(n=st.integers(0, 400), frac=st.floats(0.0, 1.0))
def test_holdout_exact_size_and_complement(spark, n, frac):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    s = split.holdout(df, frac, 7, "k", "v")
    rows = s.collect()
    assert len(rows) == n
    assert sum(1 for r in rows if r["v"]) == math.floor(n * frac)


@SETTINGS
@given(n=st.integers(2, 200), k=st.integers(1, 15))
def test_folds_cover_and_are_monotone(spark, n, k):
    df = spark.range(1, n + 1).withColumnRenamed("id", "i")
    got = [r["fold"] for r in split.contiguous_folds(df, k, "i").orderBy("i").collect()]
    assert got == sorted(got)
    assert set(got) <= set(range(1, k + 1))
    assert got[0] == 1 and got[-1] == k      # first row in fold 1, last row in fold k


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=100))
def test_mean_fill_no_nulls_and_keeps_values(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    out = {r["i"]: r["x"] for r in impute.mean(df, ["x"]).collect()}
    present = [v for v in vals if v is not None]
    for i, v in enumerate(vals):
        if v is not None:
            assert out[i] == v
        elif present:
            assert out[i] == pytest.approx(sum(present) / len(present), rel=1e-9, abs=1e-6)
        else:
            assert out[i] is None     # an all-null column stays null


@SETTINGS
@given(pairs=st.lists(st.tuples(st.sampled_from(["YES", "NO"]), st.sampled_from(["YES", "NO"])),
                      min_size=1, max_size=100))
def test_confusion_cells_sum_to_n(spark, pairs):
    df = spark.createDataFrame(pairs, "pred string, actual string")
    r = evaluate.confusion(df, "pred", "actual").first()
    assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(pairs)
    assert r["tp"] == sum(1 for p, a in pairs if p == a == "YES")


def test_fractions_shuffle_counts_not_rows(spark):
    """No table row goes through a join's shuffle: the fractions' limits are broadcast."""
    from sparkprep.operators import split
    df = spark.range(500).withColumnRenamed("id", "k")
    out = split.fractions(df, [0.1, 0.5, 1.0], 123, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    got = {r.fraction: r.n for r in out.groupBy("fraction").agg({"k": "count"}).withColumnRenamed("count(k)", "n").collect()}
    assert got == {0.1: 50, 0.5: 250, 1.0: 500}
