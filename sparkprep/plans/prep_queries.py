"""Encoding, class weights, threshold metrics, cross-validation metrics,
exact KNN and feature assembly on labelled documents / parts / embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators import encode, evaluate, knn, pivot_knn, split
from sparkprep.plans.registry import q, query
from sparkprep.session import materialize
from sparkprep.sources.tables import table

SEED = fv.SPLIT_SEED


def labelled_docs(spark, d):
    """Listing-shaped labelled table: documents with a YES/NO target."""
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "YES").otherwise("NO").alias("perfect_rating_score"))
    return docs.join(labels, "doc_id")


def _score(col="n_chars"):
    return (F.col(col) % 100) / F.lit(100.0)


_LAB_SQL = """SELECT d.doc_id, d.n_chars, d.text, (d.n_chars % 100) / 100.0::DOUBLE AS score,
       CASE WHEN l.quality = 1 THEN 'YES' ELSE 'NO' END AS actual
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
_RATES_SQL = """round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
  round(tp / nullif(tp + fn, 0), 6) AS tpr, round(fp / nullif(fp + tn, 0), 6) AS fpr"""
_CELLS_SQL = """CAST(count_if(pred = 'YES' AND actual = 'YES') AS BIGINT) AS tp,
  CAST(count_if(pred = 'YES' AND actual = 'NO') AS BIGINT) AS fp,
  CAST(count_if(pred = 'NO' AND actual = 'NO') AS BIGINT) AS tn,
  CAST(count_if(pred = 'NO' AND actual = 'YES') AS BIGINT) AS fn"""
_P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("ordinal_encode_wide", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS c_name FROM customer),
l AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS code FROM (SELECT DISTINCT c_name FROM c WHERE c_name IS NOT NULL) x)
SELECT c_custkey, c.c_name, CAST(coalesce(code, (SELECT count(*) + 1 FROM l)) AS INTEGER) AS c_name_code
FROM c LEFT JOIN l ON c.c_name = l.c_name""")
def ordinal_encode_wide(spark, d):
    """Codes of a column with a level per row, by a level table."""
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("c_name"))
    return encode.ordinal_by_table(c, "c_name", encode.level_codes(c, "c_name"))


@query("ordinal_encode", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS p_type_code,
       CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS p_brand_code FROM part""")
def ordinal_encode(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_brand")
    return encode.ordinal(p, ["p_type", "p_brand"]).select("p_partkey", "p_type_code", "p_brand_code")


@query("dummies", "SELECT p_partkey, p_size, " + ", ".join(
    f"CAST(p_type = {q(t)} AS INTEGER) AS p_type_{t}" for t in _P_TYPES) + " FROM part")
def dummies(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_size")
    enc = encode.Dummies(["p_type"]).fit(p)
    return enc.transform(p)


@query("class_weights", f"""
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'YES' ELSE 'NO' END AS perfect_rating_score,
       CAST(l.quality = 1 AS INTEGER) AS label,
       CASE WHEN l.quality = 1 THEN {fv.CLASS_WEIGHTS['YES']} ELSE {fv.CLASS_WEIGHTS['NO']} END::DOUBLE AS weight_rf,
       CASE WHEN l.quality = 1 THEN {fv.BOOST_POS_WEIGHT} ELSE 1.0 END::DOUBLE AS weight_gbt
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def class_weights(spark, d):
    lab = labelled_docs(spark, d)
    y = "perfect_rating_score"
    return lab.select("doc_id", y, encode.binary_label(y).alias("label"),
                      encode.class_weight(y, fv.CLASS_WEIGHTS).alias("weight_rf"),
                      encode.class_weight(y, {"YES": fv.BOOST_POS_WEIGHT}).alias("weight_gbt"))


_THRESHOLDS = [(fv.THRESHOLDS["forest"], True), (fv.THRESHOLDS["default"], False),
               (fv.THRESHOLDS["enriched_forest"], False)]


@query("threshold_metrics", f"""
WITH b AS ({_LAB_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
             count(*) OVER () AS cnt FROM b),
s AS (SELECT *, CASE WHEN rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE) THEN 'valid' ELSE 'train' END AS split FROM r),
t(threshold, inclusive) AS (VALUES {", ".join(f"({th}::DOUBLE, {str(inc).lower()})" for th, inc in _THRESHOLDS)}),
p AS (SELECT split, threshold, inclusive, actual,
        CASE WHEN (inclusive AND score >= threshold) OR (NOT inclusive AND score > threshold)
             THEN 'YES' ELSE 'NO' END AS pred FROM s, t),
c AS (SELECT split, threshold, inclusive, {_CELLS_SQL} FROM p GROUP BY split, threshold, inclusive)
SELECT split, threshold, inclusive, tp, fp, tn, fn, {_RATES_SQL} FROM c""")
def threshold_metrics(spark, d):
    lab = labelled_docs(spark, d).select("doc_id", _score().alias("score"),
                                         F.col("perfect_rating_score").alias("actual"))
    s = split.holdout(lab, fv.VALID_FRACTION, SEED, "doc_id", "__v") \
        .withColumn("split", F.when(F.col("__v"), "valid").otherwise("train"))
    th = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(inc).alias("inclusive"))
                   for t, inc in _THRESHOLDS])
    x = s.withColumn("__t", F.explode(th)).select("split", "actual", "score", "__t.*")
    pred = F.when((F.col("inclusive") & (F.col("score") >= F.col("threshold")))
                  | (~F.col("inclusive") & (F.col("score") > F.col("threshold"))), "YES").otherwise("NO")
    m = evaluate.binary_metrics(x.withColumn("pred", pred), "pred", "actual",
                                ["split", "threshold", "inclusive"])
    return m.select("split", "threshold", "inclusive", "tp", "fp", "tn", "fn",
                    *[F.round(c, 6).alias(c) for c in ("accuracy", "tpr", "fpr")])


@query("cv_metrics", f"""
WITH b AS ({_LAB_SQL}),
f AS (SELECT *, CASE WHEN score > 0.5 THEN 'YES' ELSE 'NO' END AS pred,
             CAST(greatest(1, ceil((rn - 1) * {fv.CV_FOLDS} / (cnt - 1)::DOUBLE)) AS INTEGER) AS fold
      FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS cnt FROM b) x),
per AS (SELECT fold, {_CELLS_SQL} FROM f GROUP BY fold),
tot AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(tn) AS tn, sum(fn) AS fn FROM per),
m AS (SELECT CAST(fold AS VARCHAR) AS fold, 'heldout' AS part, tp, fp, tn, fn FROM per
      UNION ALL
      SELECT CAST(per.fold AS VARCHAR), 'train', tot.tp - per.tp, tot.fp - per.fp, tot.tn - per.tn, tot.fn - per.fn
      FROM per, tot),
r AS (SELECT fold, part, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / nullif(tp + fn, 0) AS tpr,
             fp / nullif(fp + tn, 0) AS fpr FROM m)
SELECT fold, part, round(accuracy, 6) AS accuracy, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr FROM r
UNION ALL
SELECT 'mean', part, round(avg(accuracy), 6), round(avg(tpr), 6), round(avg(fpr), 6) FROM r GROUP BY part""")
def cv_metrics(spark, d):
    lab = labelled_docs(spark, d).select("doc_id", F.col("perfect_rating_score").alias("actual"),
                                         evaluate.classify(_score(), 0.5, inclusive=False).alias("pred"))
    folded = split.contiguous_folds(lab, fv.CV_FOLDS, "doc_id")
    m = evaluate.cv_metrics(folded, "pred", "actual")
    return m.select("fold", "part", *[F.round(c, 6).alias(c) for c in ("accuracy", "tpr", "fpr")])


_SWEEP_SQL = f"""
WITH b AS ({_LAB_SQL}),
c AS (SELECT score, count_if(actual = 'YES') AS pos, count_if(actual = 'NO') AS neg FROM b GROUP BY score),
s AS (SELECT score, pos, neg, coalesce(sum(pos) OVER w, 0) AS fn, coalesce(sum(neg) OVER w, 0) AS tn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
      FROM c WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


@query("threshold_sweep", _SWEEP_SQL + """
SELECT round(score, 6) AS threshold, CAST(p - fn AS BIGINT) AS tp, CAST(n - tn AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
  round((p - fn + tn) / (p + n), 6) AS accuracy, round((p - fn) / nullif(p, 0), 6) AS tpr, round((n - tn) / nullif(n, 0), 6) AS fpr
FROM s""")
def threshold_sweep(spark, d):
    lab = labelled_docs(spark, d).select(_score().alias("score"), encode.binary_label("perfect_rating_score").alias("y"))
    sweep = evaluate.threshold_sweep(lab, "score", "y")
    return sweep.select(F.round("threshold", 6).alias("threshold"), "tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in ("accuracy", "tpr", "fpr")])


@query("auc_exact", _SWEEP_SQL + """
SELECT CAST(max(p) AS BIGINT) AS n_pos, CAST(max(n) AS BIGINT) AS n_neg, round(sum(pos * (tn + neg / 2.0)) / (max(p)::DOUBLE * max(n)), 6) AS auc FROM s""")
def auc_exact(spark, d):
    lab = labelled_docs(spark, d).select(_score().alias("score"), encode.binary_label("perfect_rating_score").alias("y"))
    return evaluate.auc_exact(lab, "score", "y").select("n_pos", "n_neg", F.round("auc", 6).alias("auc"))


_KNN_SQL = f"""
WITH r AS (SELECT vec_id, label, embedding,
             row_number() OVER (ORDER BY md5('{SEED}:' || CAST(vec_id AS VARCHAR)), vec_id) AS rn,
             count(*) OVER () AS cnt FROM embeddings),
s AS (SELECT *, rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE) AS is_valid FROM r),
tr AS (SELECT vec_id AS tid, label AS tlabel, embedding AS te FROM s WHERE NOT is_valid),
d AS (SELECT s.vec_id AS qid, tr.tid, tr.tlabel,
        list_sum(list_transform(range(1, len(s.embedding) + 1),
          lambda i: (s.embedding[i]::DOUBLE - tr.te[i]::DOUBLE) * (s.embedding[i]::DOUBLE - tr.te[i]::DOUBLE))) AS dist
      FROM s, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS k FROM d) a
       WHERE k <= {fv.KNN_K}),
v AS (SELECT qid, tlabel, count(*) AS c FROM nn GROUP BY qid, tlabel),
best AS (SELECT qid, tlabel AS predicted FROM
         (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c DESC, tlabel) AS k FROM v) b WHERE k = 1)
SELECT s.vec_id, CAST(s.label AS BIGINT) AS actual, CAST(best.predicted AS BIGINT) AS predicted,
       CASE WHEN s.is_valid THEN 'valid' ELSE 'train' END AS split
FROM s JOIN best ON s.vec_id = best.qid"""


def _knn_rows(spark, d, near):
    """Every embedding with the vote of its nearest training rows, found by ``near``."""
    e = table(spark, d, "embeddings")
    # the split table feeds the train side, the query side and the output
    s = materialize(split.holdout(e, fv.VALID_FRACTION, SEED, "vec_id", "is_valid"))
    train = s.where(~F.col("is_valid"))
    pred = knn.vote(near(train, s, fv.KNN_K, vec="embedding", label="label", train_id="vec_id", query_id="vec_id"), fv.KNN_K)
    out = s.select("vec_id", F.col("label").cast("long").alias("actual"),
                   F.when(F.col("is_valid"), "valid").otherwise("train").alias("split"))
    return out.join(pred.withColumnRenamed("qid", "vec_id"), "vec_id").select(
        "vec_id", "actual", F.col("predicted").cast("long").alias("predicted"), "split")


@query("knn_predict", _KNN_SQL)
def knn_predict(spark, d):
    return _knn_rows(spark, d, knn.candidates)


@query("knn_pivot", _KNN_SQL)
def knn_pivot(spark, d):
    """The same rows by pivot cells: each training row is sent once."""
    return _knn_rows(spark, d, pivot_knn.candidates)


@query("knn_lsh")
def knn_lsh(spark, d):
    """Approximate vote by hashed buckets, with how many of the exact neighbours of
    each row it found."""
    e = materialize(split.holdout(table(spark, d, "embeddings"), fv.VALID_FRACTION, SEED, "vec_id", "is_valid"))
    args = (e.where(~F.col("is_valid")), e, fv.KNN_K)
    names = dict(vec="embedding", label="label", train_id="vec_id", query_id="vec_id")
    found = materialize(pivot_knn.lsh_candidates(*args, **names))
    hits = pivot_knn.recall(found, pivot_knn.candidates(*args, **names))
    return (hits.join(knn.vote(found, fv.KNN_K), "qid", "left")
            .select(F.col("qid").alias("vec_id"), F.col("predicted").cast("long").alias("predicted"), "n_exact", "n_found"))


@query("feature_label_split", """
SELECT d.doc_id, round(CAST(n_chars AS DOUBLE), 6) AS n_chars_f, round(ln(1 + n_chars), 6) AS log_chars,
       round(CAST(len(string_split(text, ',')) - 1 AS DOUBLE), 6) AS n_commas, l.quality AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def feature_label_split(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    feats = docs.select("doc_id", F.col("quality").alias("label"),
                        F.col("n_chars").cast("double").alias("n_chars_f"),
                        F.log1p("n_chars").alias("log_chars"),
                        (F.size(F.split("text", ",")) - 1).cast("double").alias("n_commas"))
    names = ["n_chars_f", "log_chars", "n_commas"]
    x = encode.assemble(feats, names).select("doc_id", "features", "label")   # features / label
    back = encode.disassemble(x, "features", names)
    return back.select("doc_id", *[F.round(n, 6).alias(n) for n in names], "label")


@query("confusion_table", f"""
WITH b AS ({_LAB_SQL}),
p AS (SELECT CASE WHEN score >= {fv.THRESHOLDS['forest']}::DOUBLE THEN 'YES' ELSE 'NO' END AS predicted, actual FROM b)
SELECT predicted, CAST(count_if(actual = 'NO') AS BIGINT) AS actual_NO,
       CAST(count_if(actual = 'YES') AS BIGINT) AS actual_YES
FROM p GROUP BY predicted""")
def confusion_table(spark, d):
    from sparkprep.operators import agg
    lab = labelled_docs(spark, d).select(
        evaluate.classify(_score(), fv.THRESHOLDS["forest"], inclusive=True).alias("predicted"),
        F.col("perfect_rating_score").alias("actual"))
    return agg.crosstab(lab, "predicted", "actual", ["NO", "YES"], name_fmt="actual_{}")
