"""Language identification by the nearest of several centroids per language.

A text becomes the counts of its byte bigrams and trigrams (A-Z lower-cased,
other ASCII characters as one space), hashed to ``DIM`` places; logarithmic
counts times inverse document frequencies, scaled to length 1. A language's
training texts are clustered by spherical k-means into ``clusters`` centroids,
and a text takes the language of the centroid with the largest cosine. Each
centroid rejects texts that are farther away than nearly all its members were:
further than ``margin`` times the distance that ``quantile`` of them keep, and
than ``LEAST_REACH``.

Document frequencies and the numbers of rows per language are counted over all
training rows. Clustering takes at most ``max_rows`` texts of a language
(default ``MAX_ROWS``, those with the smallest hash of their id), so one task
per language is bounded; the centroids (languages x clusters x DIM floats) are
all that is broadcast, and prediction is one pass without a shuffle. What grows
with the number of languages only is sent through the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
other texts get the nearest language and the cosine as score. Ties go to the
language that sorts first. Rows with null language or id are never learnt from.
Without any training row all texts are ``und``. Repeated rows are predicted
alike; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import LOWER, nested_row, stored, table, text_chunks

DIM = 4096
CLUSTERS = 3
MAX_ROWS = 600
QUANTILE = 0.995
MARGIN = 1.5
LEAST_REACH = 0.2
UNKNOWN = "und"
PIECE = 256  # texts counted at a time, DIM numbers each

_CODE = LOWER.copy()
_CODE[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = 32


def counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """n-gram counts of each text, one row of ``DIM`` per text."""
    n = len(at) - 1
    code = _CODE[data].astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(at))
    blank = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (text[1:] == text[:-1]))
    code, text = code[keep], text[keep]
    two = code[:-1] << np.uint32(8) | code[1:]
    three = two[:-1] << np.uint32(8) | code[2:]
    out = np.zeros(n * DIM)
    for gram, far in ((two, 1), (three, 2)):
        inside = text[far:] == text[:len(text) - far]
        place = (gram[inside] + np.uint32(far)) * np.uint32(2654435761) >> np.uint32(32 - 12)
        out += np.bincount(text[far:][inside] * DIM + place, minlength=n * DIM)
    return out.reshape(n, DIM)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(found) * idf
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def _frequencies(batches):
    total = np.zeros(DIM, np.int64)
    rows = 0
    for batch in batches:
        for _, _, data, at in text_chunks(batch.column(0), most=PIECE):
            total += (counts(data, at) > 0).sum(axis=0)
        rows += batch.num_rows
    place = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(place, DIM), pa.int32()), pa.array(np.append(total[place], rows), pa.int64())], ["place", "n"])


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, started from the rows farthest from those chosen."""
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    best = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[chosen[-1]])
    centres = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                mean = x[own == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres, np.argmax(x @ centres.T, axis=1)


def _fit_language(idf, clusters, quantile, margin):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("order", "ascending"), ("id", "ascending")])
        x = np.concatenate([vectors(counts(data, at), idf) for _, _, data, at in text_chunks(group.column("text"), most=PIECE)])
        x = x[x.any(axis=1)]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "reach": pa.array([], pa.float64())})
        centres, own = cluster(x, clusters)
        far = [1 - x[own == c] @ centres[c] if (own == c).any() else np.zeros(1) for c in range(len(centres))]
        reach = [max(LEAST_REACH, float(np.quantile(d, quantile) * margin)) for d in far]
        return pa.table({"lang": [group.column("lang")[0].as_py()] * len(centres), "centre": [c.astype(np.float32).tobytes() for c in centres], "reach": reach})
    return run


class LanguageModel:
    def __init__(self, langs: list[str], centres: np.ndarray, reach: np.ndarray, idf: np.ndarray):
        self.langs, self.centres, self.reach, self.idf = langs, centres, reach, idf


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", eligible=None,
                 clusters: int = CLUSTERS, max_rows: int = MAX_ROWS, quantile: float = QUANTILE, margin: float = MARGIN) -> LanguageModel:
    rows = nested_row(docs).select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"),
                                   F.col("row").getField(lang_col).cast("string").alias("lang"))
    rows = rows.filter("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    if eligible is not None:
        rows = rows.filter(eligible(F.col("id")))
    sums = rows.select("text").mapInArrow(_frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    df = np.zeros(DIM + 1)
    for r in sums.collect():  # DIM + 1 rows at most
        df[r["place"]] = r["n"]
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1
    # A threshold on the hash leaves about twice the bound of each language, of
    # which those with the smallest hashes are taken.
    size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    order = F.xxhash64(F.lit("language"), "id")
    near = rows.withColumn("order", order).join(F.broadcast(stored(size, "languages")), "lang")
    near = near.filter((F.col("order").cast("double") / 2.0 ** 64 + 0.5) * F.col("size") < 2.0 * max_rows)
    few = near.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("order", "id"))).alias("all"))
    limit = few.select("lang", F.col("all")[F.least(F.size("all"), F.lit(max_rows)) - 1]["order"].alias("last"))
    near = near.join(F.broadcast(stored(limit, "limits")), "lang").filter("order <= last").select("lang", "id", "order", "text")
    found = near.groupBy("lang").applyInArrow(_fit_language(idf, clusters, quantile, margin), "lang string, centre binary, reach double")
    model = sorted((r["lang"], bytes(r["centre"]), r["reach"]) for r in found.collect())
    centres = np.array([np.frombuffer(c, np.float32) for _, c, _ in model], np.float64).reshape(-1, DIM)
    return LanguageModel([m[0] for m in model], centres, np.array([m[2] for m in model]), idf)


def predict(column, model: LanguageModel):
    """(language, cosine, rejected) of each text."""
    lang = np.full(len(column), UNKNOWN, object)
    score, rejected = np.zeros(len(column)), np.ones(len(column), bool)
    letters = pc.match_substring_regex(pc.fill_null(column, ""), r"\pL").to_numpy(zero_copy_only=False)
    if len(model.langs):
        names = np.array(model.langs, object)
        for i, j, data, at in text_chunks(column, most=PIECE):
            near = vectors(counts(data, at), model.idf) @ model.centres.T
            best = np.argmax(near, axis=1)
            lang[i:j], score[i:j] = names[best], np.clip(near[np.arange(j - i), best], 0, 1)
            rejected[i:j] = 1 - score[i:j] > model.reach[best]
    lang[~letters], score[~letters], rejected[~letters] = UNKNOWN, 0.0, True
    return lang, score, rejected


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score, rejected (the text is out
    of the reach of the centroid that is nearest)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            lang, score, rejected = predict(batch.column(1), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                                             ["id", "lang_pred", "score", "rejected"])

    rows = nested_row(docs).select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")


def _held_out(id_):
    return F.crc32(id_.cast("string").cast("binary")) % 4 == 2


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs, eligible=lambda i: ~_held_out(i))
    out = identify(docs, model)
    return out.select(F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "rejected")
