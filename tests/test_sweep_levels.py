import random
from collections import Counter
from hashlib import md5

from pyspark.sql import functions as F

from sparkprep.operators import evaluate, profile


def scored(spark, rows):
    return spark.createDataFrame(rows, "p double, y int")


def test_auc_and_sweep_against_all_pairs(spark):
    rng = random.Random(7)
    rows = [(rng.choice([0.1, 0.2, 0.2, 0.5, 0.9, rng.random()]), rng.randrange(2)) for _ in range(300)] + [(None, 1), (0.3, None)]
    pos, neg = ([p for p, y in rows if y == k and p is not None] for k in (1, 0))
    r = evaluate.auc_exact(scored(spark, rows), "p", "y").first()
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert (r.n_pos, r.n_neg) == (len(pos), len(neg)) and abs(r.auc - want) < 1e-12
    sweep = {s.threshold: (s.tp, s.fp, s.tn, s.fn) for s in evaluate.threshold_sweep(scored(spark, rows), "p", "y").collect()}
    assert sweep == {t: (sum(p >= t for p in pos), sum(p >= t for p in neg), sum(p < t for p in neg), sum(p < t for p in pos)) for t in set(pos + neg)}


def test_auc_of_one_class_or_none(spark):
    r = evaluate.auc_exact(scored(spark, [(0.5, 1), (0.6, 1)]), "p", "y").first()
    assert (r.n_pos, r.n_neg, r.auc) == (2, 0, None)
    r = evaluate.auc_exact(scored(spark, []), "p", "y").first()
    assert (r.n_pos, r.n_neg, r.auc) == (0, 0, None)
    assert evaluate.threshold_sweep(scored(spark, []), "p", "y").count() == 0


def test_level_counts_against_counting(spark):
    rng = random.Random(3)
    a = [rng.choice("abcdefghij") if rng.random() < 0.9 else None for _ in range(400)]
    b = [f"text {i}" * 50 for i in range(400)]  # all distinct: ties settled by digest
    c = ["one"] * 300 + [None] * 100
    df = spark.createDataFrame(list(zip(a, b, c, range(400))), "a string, `b.x` string, c string, n long")
    got = {}
    for r in profile.level_counts(df).collect():
        got.setdefault(r.column_name, []).append((r.level, r.n))
    for name, values in (("a", a), ("b.x", b), ("c", c)):
        counts = Counter(v for v in values if v is not None)
        top = sorted(counts.items(), key=lambda x: (-x[1], md5(x[0].encode()).hexdigest()))[:6]
        rest = sum(counts.values()) - sum(n for _, n in top)
        assert sorted(got[name]) == sorted(top + ([("(Other)", rest)] if rest else []))
    assert profile.level_counts(df.select("n")).count() == 0
    assert profile.level_counts(df.where(F.lit(False))).count() == 0
