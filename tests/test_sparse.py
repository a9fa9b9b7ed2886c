from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from sparkprep.operators import sparse


def test_many_levels_nulls_and_unseen(spark):
    train = spark.range(100_000).select("id", F.concat(F.lit("v"), "id").alias("a.b"), F.when(F.col("id") % 2 == 0, "even").alias("parity"))
    levels, size = sparse.fit_levels(train, ["a.b", "parity"], first=1)
    assert size == 100_002 and levels.count() == 100_001
    assert levels.where("column_name = 'parity'").first()["index"] == 100_001
    rows = spark.createDataFrame([(1, "v7", "even", 2.5), (2, "new", None, 0.0), (3, None, None, None), (4, "v0", "odd", 1.0)],
                                 "k int, `a.b` string, parity string, x double")
    folded = sparse.fold(sparse.level_entries(rows, "k", ["x"], levels))
    want = {n: i + 1 for i, n in enumerate(sorted(f"v{i}" for i in range(100_000)))}
    got = {r["key"]: (r["indices"], r["values"]) for r in folded.collect()}
    assert got == {1: ([0, want["v7"], 100_001], [2.5, 1.0, 1.0]), 2: ([], []), 3: ([], []), 4: ([0, want["v0"]], [1.0, 1.0])}
    vectors = {r["key"]: r["features"] for r in sparse.vectors(folded, size).collect()}
    assert vectors[1].size == size and vectors[1][100_001] == 1.0 and vectors[3].numNonzeros() == 0


def test_vectors_feed_a_model(spark):
    rows = spark.createDataFrame([(i, "yes" if i % 3 else "no") for i in range(60)], "k int, c string")
    levels, size = sparse.fit_levels(rows, ["c"])
    data = sparse.vectors(sparse.fold(sparse.level_entries(rows, "k", [], levels)), size)
    data = data.withColumn("label", (F.col("key") % 3 != 0).cast("double"))
    model = LogisticRegression().fit(data)
    assert model.transform(data).where("prediction <> label").count() == 0


def test_terms_and_empty_tables(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc int")
    counts = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "z", 4)], "doc int, term string, n long")
    numbers, size = sparse.number_terms(spark.createDataFrame([("b",), ("a",), ("c",)], "term string"))
    assert size == 3
    got = {r["key"]: (r["indices"], r["values"]) for r in sparse.fold(sparse.term_entries(docs, "doc", counts, numbers)).collect()}
    assert got == {1: ([0, 1], [1.0, 2.0]), 2: ([], []), 3: ([], [])}
    none = docs.where(F.lit(False)).withColumn("c", F.lit("x"))
    levels, size = sparse.fit_levels(none, ["c"])
    assert size == 0 and sparse.fold(sparse.level_entries(none, "doc", [], levels)).count() == 0
