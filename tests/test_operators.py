"""Imputation, splits, folds, multi-hot, joins, drift, metrics and KNN."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from sparkprep.operators import agg, drift, evaluate, impute, join, knn, multi, split


def test_mean_and_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "x double")
    assert sorted(r["x"] for r in impute.mean(df, ["x"]).collect()) == pytest.approx(
        sorted([1.0, 14 / 3, 3.0, 10.0]))
    assert sorted(r["x"] for r in impute.median(df, ["x"]).collect()) == [1.0, 3.0, 3.0, 10.0]


def test_group_first_all_null_group_and_null_key(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", "x"), (3, "a", "y"), (4, "b", None), (5, None, None), (6, None, "z")],
        "id int, g string, v string")
    got = {r["id"]: r["v"] for r in impute.group_first(df, "v", "g", "id").collect()}
    assert got == {1: "x", 2: "x", 3: "y", 4: None, 5: "z", 6: "z"}


def test_holdout_sizes_disjoint_complete(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    s = split.holdout(df, 0.3, 123, "k", "v")
    assert s.where("v").count() == 300
    assert s.count() == 1000
    again = {r["k"] for r in split.holdout(df.repartition(7), 0.3, 123, "k", "v").where("v").collect()}
    assert again == {r["k"] for r in s.where("v").collect()}      # partitioning-independent


def test_nested_and_fractions(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    n = {r["split"]: r["count"] for r in split.nested_holdout(df, "k").groupBy("split").count().collect()}
    assert n == {"train": 700, "valid_use": 270, "valid_final": 30}
    fr = {r["fraction"]: r["count"] for r in
          split.fractions(df, [0.1, 0.5, 1.0], 1, "k").groupBy("fraction").count().collect()}
    assert fr == {0.1: 100, 0.5: 500, 1.0: 1000}


@pytest.mark.parametrize("n,k", [(31, 3), (100, 15), (16, 15)])
def test_contiguous_folds_equal_cut(spark, n, k):
    df = spark.range(1, n + 1).withColumnRenamed("id", "i")
    got = {r["i"]: r["fold"] for r in split.contiguous_folds(df, k, "i").collect()}
    # cut(seq(1, n), k): breaks at 1 + j * (n - 1) / k, right-closed
    edges = [1 + j * (n - 1) / k for j in range(k + 1)]
    for i in range(1, n + 1):
        ref = next(j for j in range(1, k + 1) if i <= edges[j] + 1e-9)
        assert got[i] == ref
    assert set(got.values()) == set(range(1, k + 1))


def test_multi_hot_row_sums_equal_distinct_tokens(spark):
    df = spark.createDataFrame([(1, "a, b,b"), (2, None), (3, "C")], "id int, c string")
    t = multi.tokens(df, "c", null_token="missing_value_placeholder")
    wide = multi.one_hot(t, "c", multi.collect_vocabulary(t, "c"))
    cols = [c for c in wide.columns if c.startswith("has_")]
    for r in wide.collect():
        src = {1: {"a", "b"}, 2: {"missing_value_placeholder"}, 3: {"c"}}[r["id"]]
        assert sum(r[c] for c in cols) == len(src)


def test_make_unique():
    assert multi.make_unique(["has_a", "has_a", "has_b", "has_a"]) == ["has_a", "has_a.1", "has_b", "has_a.2"]


def test_top_n_keeps_ties(spark):
    counts = spark.createDataFrame([(f"t{i}", c) for i, c in enumerate([9, 8, 7, 7, 7, 1])], "k string, n long")
    assert {r["k"] for r in agg.top_n_with_ties(counts, 3, "n").collect()} == {"t0", "t1", "t2", "t3", "t4"}


def test_positional_join_count_mismatch(spark):
    a = spark.range(3).withColumnRenamed("id", "x")
    for n in (4, 0):        # a longer and an empty right side
        b = spark.range(n).withColumnRenamed("id", "y")
        with pytest.raises(Exception, match="different row counts"):
            join.positional(a, b, ["x"], ["y"]).collect()
    same = join.positional(a, spark.range(3).withColumnRenamed("id", "y"), ["x"], [-F.col("y")])
    assert sorted((r["x"], r["y"]) for r in same.collect()) == [(0, 2), (1, 1), (2, 0)]


def test_distinct_first_and_enrich_padding(spark):
    extra = spark.createDataFrame([("02134", 1, "first"), ("02134", 2, "dup"), ("10001", 3, "ny")],
                                  "zip string, ord int, v string")
    first = join.distinct_first(extra, "zip", "ord")
    listings = spark.createDataFrame([(1, 2134), (2, 10001), (3, 99999)], "id int, zipcode int")
    got = {r["id"]: r["v"] for r in join.enrich(listings, first, "zipcode", "zip", pad=5).collect()}
    assert got == {1: "first", 2: "ny"}


def test_drift_both_directions(spark):
    tr = spark.createDataFrame([("a", "x"), ("b", "x")], "c1 string, c2 string")
    te = spark.createDataFrame([("a", "y"), ("c", "x")], "c1 string, c2 string")
    got = {(r["column_name"], r["level"], r["side"]) for r in drift.levels(tr, te).collect()}
    assert got == {("c1", "b", "train_only"), ("c1", "c", "test_only"), ("c2", "y", "test_only")}


def test_confusion_with_empty_class(spark):
    df = spark.createDataFrame([("YES", "YES"), ("YES", "YES"), ("NO", "YES")], "pred string, actual string")
    r = evaluate.binary_metrics(df, "pred", "actual").first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"]) == (2, 0, 0, 1)
    assert r["fpr"] is None and r["tpr"] == pytest.approx(2 / 3)
    assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == 3


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(120, 5))
    y = rng.integers(0, 3, 120)
    rows = [(i, X[i].tolist(), int(y[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    train, queries = df.where("id >= 40"), df.where("id < 40")
    got = {r["qid"]: r["predicted"] for r in
           knn.knn_predict(train, queries, 7, vec="embedding", label="label", train_id="id",
                           query_id="id", query_block_rows=16, train_chunk_rows=25).collect()}
    for q in range(40):
        d = ((X[40:] - X[q]) ** 2).sum(1)
        order = np.lexsort((np.arange(40, 120), d))[:7]
        labs, cnt = np.unique(y[40:][order], return_counts=True)
        assert got[q] == labs[np.argmax(cnt)]


def test_multi_hot_missing_list_is_its_own_level(spark):
    df = spark.createDataFrame([(1, "Wifi, TV"), (2, None)], "id int, c string")
    toks = multi.tokens(df, "c")
    wide = multi.one_hot(toks, "c", multi.collect_vocabulary(toks, "c"))
    got = {r["id"]: r.asDict() for r in wide.collect()}
    assert "has_NA" in wide.columns
    assert got[1]["has_NA"] == 0 and got[1]["has_wifi"] == 1 and got[1]["has_tv"] == 1
    assert got[2]["has_NA"] == 1 and got[2]["has_wifi"] == 0


def test_unicode_punctuation_option(spark):
    from sparkprep.functions.text import strip_punct
    row = spark.createDataFrame([("«Café», d'été!",)], "c string").select(
        strip_punct("c").alias("a"), strip_punct("c", unicode=True).alias("u")).first()
    assert row["a"] == "«Café» dété" and row["u"] == "Café dété"


@pytest.mark.parametrize("n,frac,buckets", [(1, 0.5, 4), (7, 0.3, 3), (500, 0.3, 8), (500, 0.999, 5)])
def test_hash_select_matches_brute_force(spark, n, frac, buckets):
    import hashlib
    import math
    df = spark.range(0, n).withColumnRenamed("id", "k")
    got = {r["k"] for r in split.hash_select(df, frac, 123, "k", "sel", n_buckets=buckets)
           .where("sel").collect()}
    order = sorted(range(n), key=lambda k: (hashlib.md5(f"123:{k}".encode()).hexdigest(), k))
    assert got == set(order[:math.floor(n * frac)])


def test_fractions_grouped_brute_force(spark):
    import hashlib
    import math
    df = spark.range(0, 300).withColumnRenamed("id", "k")
    out = split.fractions(df, [0.2, 0.7], 9, "k").collect()
    for f in (0.2, 0.7):
        got = {r["k"] for r in out if r["fraction"] == f}
        order = sorted(range(300), key=lambda k: (hashlib.md5(f"9:{f}:{k}".encode()).hexdigest(), k))
        assert got == set(order[:math.floor(300 * f)])


def test_numeric_summary_and_null_split(spark):
    from sparkprep.operators import profile
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, None), (3, 4.0, "Not Mentioned")],
                               "i int, x double, s string")
    summ = {r["column_name"]: r for r in profile.numeric_summary(df).collect()}
    assert set(summ) == {"i", "x"}
    assert summ["x"]["n"] == 2 and summ["x"]["mean"] == 3.0 and summ["i"]["max"] == 3.0
    ns = {r["category"]: r["n"] for r in profile.null_split(df, "s").collect()}
    assert ns == {"NA": 1, "Non-NA": 2}
    ss = {r["category"]: r["n"] for r in profile.null_split(df, "s", "Not Mentioned").collect()}
    assert ss == {"Not Mentioned": 1, "Other": 2}   # null is not the sentinel


def test_sparse_one_hot_open_vocabulary(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, "b")], "id int, c string")
    toks = multi.tokens(df, "c", null_token="missing_value_placeholder")
    model, out = multi.sparse_one_hot(toks, "c")
    vocab = model.vocabulary
    got = {r["id"]: {vocab[i] for i in r["features"].indices} for r in out.collect()}
    assert got == {1: {"a", "b"}, 2: {"missing_value_placeholder"}, 3: {"b"}}


def test_column_management(spark):
    from pyspark.sql import functions as F

    from sparkprep.operators import cols
    a = spark.createDataFrame([(1, "X", 2.5, "y")], "`order key` int, status string, `total price` double, label string")
    b = spark.createDataFrame([(1, "x", 3.0)], "`order key` int, status string, `line count` double")
    a, b = cols.rename_pattern(a, " ", "_"), cols.rename_pattern(b, " ", "_")
    assert a.columns == ["order_key", "status", "total_price", "label"]
    la, lb = cols.align(a, b, keep_left=["label"])
    assert la.columns == ["order_key", "status", "label"] and lb.columns == ["order_key", "status"]
    low = cols.map_where(la, cols.is_string, F.lower).first()
    assert low["status"] == "x" and low["label"] == "y"
    assert cols.drop(a, "label", "missing").columns == ["order_key", "status", "total_price"]
    with pytest.raises(ValueError):
        cols.keep(a, ["order_key", "nope"])


def test_long_form_and_drift_verdict(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, None)], "id int, t array<string>")
    assert sorted(map(tuple, multi.long_form(df, "id", "t").collect())) == [(1, "a"), (1, "b")]
    tr = spark.createDataFrame([("a",), ("b",)], "c string")
    te = spark.createDataFrame([("a",), ("c",)], "c string")
    tr, te = (t.withColumn("same", F.lit("x")) for t in (tr, te))
    got = {(v["column_name"], v["n_train_only"], v["n_test_only"], v["verdict"]) for v in drift.verdict(tr, te).collect()}
    assert got == {("c", 1, 1, "different"), ("same", 0, 0, "identical")}


def test_names_that_differ_in_case_only(spark):
    assert multi.make_unique(["has_na", "has_NA", "has_na.1"]) == ["has_na", "has_NA.2", "has_na.1"]
    df = spark.createDataFrame([(1, "N/A"), (2, None)], "id int, c string")
    toks = multi.tokens(df, "c")
    got = {tuple(r) for r in multi.one_hot(toks, "c", multi.collect_vocabulary(toks, "c")).collect()}
    assert got == {(1, 1, 0), (2, 0, 1)}


def test_hash_select_keeps_null_groups(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "g") for i in range(10)], "k int, g string")
    out = split.hash_select(df, 0.4, 7, "k", "v", by="g").collect()
    assert len(out) == 10 and {g: sum(r["v"] for r in out if r["g"] == g) for g in (None, "g")} == {None: 2, "g": 2}


def test_pattern_keeps_its_case(spark):
    from sparkprep.functions import rules
    from sparkprep.functions.text import has
    df = spark.createDataFrame([("abc",), ("123",), ("ABC",)], "t string")
    assert [r[0] for r in df.select(has("t", r"\D")).collect()] == [True, False, True]
    assert [r[0] for r in df.select(rules.first_match("t", [(r"^\D+$", "word"), ("ABC", "x")], "other")).collect()] == ["word", "other", "word"]


def test_hash_select_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (None,), (3,)], "k int")
    out = split.holdout(df, 0.4, 5, "k", "v").collect()
    assert len(out) == 5 and sum(1 for r in out if r["v"]) == 2


def test_boxplot_approx_close_to_exact(spark):
    from sparkprep.operators import profile
    rng = np.random.default_rng(5)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 3000), rng.normal(100, 15, 3000))]
    df = spark.createDataFrame(rows, "g int, x double")
    ex = {r["g"]: r for r in profile.boxplot(df, "g", "x").collect()}
    ap = {r["g"]: r for r in profile.boxplot(df, "g", "x", exact=False).collect()}
    for g in ex:
        assert ap[g]["n"] == ex[g]["n"]
        for k in ("q1", "median", "q3"):
            assert abs(ap[g][k] - ex[g][k]) < 1.0     # sketch rank error << IQR
