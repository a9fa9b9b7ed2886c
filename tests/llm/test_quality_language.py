import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkprep.llm import language, quality
from sparkprep.llm.common import table

SF01 = "/root/testdata/sf0.01"


def held(i, n, r):
    return zlib.crc32(str(i).encode()) % n == r


# -- quality ------------------------------------------------------------------------

def test_quality_held_out(spark):
    rows = quality.op4_quality_classifier(spark, SF01).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(r.doc_id, 5, 0) for r in rows)
    test = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in test if y], [s for s, y in test if not y]
    assert len(bad) > 5 and np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.9


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, "good plain words", "a"), (2, None, "b"), (3, "", "c"), (None, "BAD!! BAD!!", "d"), (1, "good plain words", "a")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 0, 1), (3, None, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    weights = quality.fit_quality(docs, labels)
    out = quality.score_quality(docs, weights)
    assert sorted(out.columns) == ["doc_id", "score", "text"] and out.count() == 5
    got = [(r.doc_id, round(r.score, 9)) for r in out.collect()]
    assert len({s for i, s in got if i == 1}) == 1 and len({s for i, s in got if i in (2, 3)}) == 1
    assert quality.keep_good(docs, weights).columns == docs.columns
    none = quality.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), none).collect() == []


def plain_ftrl(rows, alpha, beta, l1, l2):
    """The updates one coordinate at a time, over dicts."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0)) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)

    for x, y in rows:
        w = {i: weight(i) for i in x}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - y) * v
            sigma = (np.sqrt(n.get(i, 0) + g * g) - np.sqrt(n.get(i, 0))) / alpha
            z[i] = z.get(i, 0) + g - sigma * w[i]
            n[i] = n.get(i, 0) + g * g
    return {i: weight(i) for i in z}


def test_training_is_ftrl():
    rows = [("the cat sat on the mat", 1), ("BUY!! NOW!!", 0), ("a cat", 1), ("NOW!! | x", 0), ("", 1)] * 5
    weights = quality.train(rows, epochs=1)
    sparse = []
    for text, y in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        number, _, count = quality.features(data, np.array([0, len(data)]))
        x = {int(i): float(c) * quality.SCALE / count[0] for i, c in zip(*np.unique(number, return_counts=True))}
        x[1 << quality.DIM_BITS] = 1.0
        sparse.append((x, y))
    want = plain_ftrl(sparse, **quality.FTRL)
    assert set(np.flatnonzero(weights)) == {i for i, w in want.items() if w}
    assert all(abs(weights[i] - w) < 1e-4 for i, w in want.items())


def test_scores_do_not_depend_on_the_batch():
    texts = ["the cat", "", "BUY!! NOW!!", "ünï cödé words | x", "a" * 3000] * 3
    weights = np.random.default_rng(0).normal(size=(1 << quality.DIM_BITS) + 1)
    one = [quality.score_texts(pa.array([t]), weights)[0] for t in texts]
    assert np.allclose(quality.score_texts(pa.array(texts), weights), one)


# -- language -----------------------------------------------------------------------

def test_language_held_out(spark):
    rows = language.op6_language_id(spark, SF01).collect()
    lang = {r.doc_id: r.lang for r in table(spark, SF01, "documents").select("doc_id", "lang").collect()}
    test = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean(test) > 0.97
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2) for r in rows)


def test_language_cases(spark):
    en, de = "the of and that with this from there", "und der die das nicht ein auf mit sich"
    train = [(i, t + f" {i}", lang, "x") for i, (t, lang) in enumerate([(en, "en"), (de, "de")] * 8)] + [(None, de, "en", "x"), (99, de, None, "x"), (98, None, "fr", "x")]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string, lang_pred string")
    model = language.fit_language(docs, clusters=2)
    assert set(model.langs) == {"en", "de"}
    test = spark.createDataFrame([(1, en), (2, "UND DER DIE"), (3, None), (4, ""), (5, "12 !?"), (6, "ж" * 50), (None, en), (1, en), (7, (en + " ") * 4000)], "doc_id long, text string")
    got = sorted(((r.id, r.lang_pred, r.score, r.rejected) for r in language.identify(test, model).collect()), key=str)
    by = {i: (p, r) for i, p, _, r in got}
    assert by[1] == ("en", False) and by[2][0] == "de" and by[3] == by[4] == by[5] == ("und", True)
    assert by[6][0] in ("de", "en") and by[6][1] and by[7][0] == "en" and len(got) == 9
    empty = language.fit_language(docs.limit(0))
    assert {r.lang_pred for r in language.identify(test, empty).collect()} == {"und"}
    assert language.identify(test.limit(0), model).collect() == []


def test_language_counts_are_plain_counts():
    texts = ["Ab  c!", "", "é x", "aaaa"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = language.counts(data, at)
    for t, row in zip(texts, got):
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
        s = []
        for c in b:
            c = c if 97 <= c <= 122 or c >= 128 else 32
            if not (c == 32 and s and s[-1] == 32):
                s.append(c)
        assert row.sum() == max(len(s) - 1, 0) + max(len(s) - 2, 0)
    assert (got[0] > 0).sum() == len({b"ab", b"b ", b" c", b"c ", b"ab ", b"b c", b" c "})


def test_clusters_split_clear_groups():
    rng = np.random.default_rng(1)
    x = np.concatenate([np.eye(6)[:1].repeat(10, 0), np.eye(6)[3:4].repeat(10, 0)]) + rng.random((20, 6)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, own = language.cluster(x, 2)
    assert len(set(own[:10])) == len(set(own[10:])) == 1 and own[0] != own[10]


if __name__ == "__main__":
    pytest.main([__file__])
