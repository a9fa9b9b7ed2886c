"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

A text is read as two streams: its tokens (runs of letters and digits with A-Z
lower-cased, and runs of one ASCII punctuation sign), and the shapes of these
tokens (lower, capitalised or upper case, digits, the sign itself, and whether a
token repeats the one before or the one before that). Their 1- and 2-grams are
hashed to ``2**DIM_BITS`` weights; a feature's value is its share of the text's
tokens times ``SCALE``. A score is the sparse dot product of those values with
the weights, through the logistic function, gathered for a whole batch at once.

Training: at most ``max_rows`` labelled rows (default ``MAX_ROWS``), those with
the smallest hash of their id, are read in the order of that hash by one task.
Everything else covers all rows: the sample is picked from the label table, the
scan of the texts keeps only picked rows, and scoring is one pass without a
shuffle in which only the weights (a fixed size) are broadcast.

Defined results: a null text counts as the empty text, which has no features and
so the score of the bias. Rows with a null id are scored and never trained on;
labels that are null are not used; of several labels of one id the largest is
used. Without a usable label every score is 0.5. Repeated rows are scored alike.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.common import BYTE, LOWER, mix, nested_row, powers, releasing, sole_cache, stored, table, text_chunks

DIM_BITS = 18
SCALE = 10.0
MAX_ROWS = 6_000
EPOCHS = 1
FTRL = {"alpha": 0.5, "beta": 1.0, "l1": 0.02, "l2": 0.05}

# Byte classes: 0 white space and control, 1 letters, digits and non-ASCII
# bytes, 2 upper-case ASCII letters, 3 digits, else a punctuation sign.
_KIND = np.zeros(256, np.uint8)
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
for _b in range(33, 127):
    if _KIND[_b] == 0:
        _KIND[_b] = _b
_UPPER = _KIND == 2
_LOWERCASE = np.zeros(256, bool)
_LOWERCASE[97:123] = True
_ALNUM = (_KIND == 1) | _UPPER | (_KIND == 3)


def _tokens(data: np.ndarray, at: np.ndarray):
    """(hash, shape, text number) of every token of the texts."""
    kind = _KIND[data]
    group = np.where(_ALNUM[data], np.uint8(1), kind)
    head = np.empty(len(data), bool)
    if len(data):
        head[0] = True
        head[1:] = group[1:] != group[:-1]
        inner = at[:-1]
        head[inner[inner < len(data)]] = True
    begins = np.flatnonzero(head)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = np.diff(np.append(begins, len(data)))
    with np.errstate(over="ignore"):
        place = np.arange(len(data)) - np.repeat(begins, lengths)
        hashes = mix(np.add.reduceat(BYTE[LOWER[data]] * powers(int(lengths.max()))[place], begins))
    upper = np.add.reduceat(_UPPER[data].astype(np.int64), begins)
    lower = np.add.reduceat(_LOWERCASE[data].astype(np.int64), begins)
    first_up = _UPPER[data[begins]]
    shape = group[begins].astype(np.uint64) << np.uint64(4)
    word = group[begins] == 1
    case = np.where(upper == 0, 1, np.where((lower == 0) & (upper > 1), 2, np.where(first_up & (upper == 1), 3, 4)))
    shape += np.where(word, case, np.minimum(lengths, 4)).astype(np.uint64)
    keep = group[begins] != 0
    hashes, shape = hashes[keep], shape[keep]
    text = np.searchsorted(at, begins[keep], side="right") - 1
    for back in (1, 2):
        same = np.zeros(len(hashes), bool)
        same[back:] = (hashes[back:] == hashes[:-back]) & (text[back:] == text[:-back])
        shape[same] += np.uint64(1 << (12 + back))
    return hashes, shape, text


def features(data: np.ndarray, at: np.ndarray):
    """(feature number, text number, tokens per text) of all n-grams."""
    hashes, shape, text = _tokens(data, at)
    out, of = [], []
    with np.errstate(over="ignore"):
        for salt, stream, longest in ((1, hashes, 2), (7, mix(shape), 2)):
            gram = stream * np.uint64(salt)
            for n in range(1, longest + 1):
                if n > 1:
                    gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + stream[n - 1:] * np.uint64(2 * n + 1)
                inside = text[n - 1:] == text[:len(text) - n + 1]
                out.append(mix(gram[inside] + np.uint64(n)) >> np.uint64(64 - DIM_BITS))
                of.append(text[:len(text) - n + 1][inside])
    return np.concatenate(out).astype(np.int64), np.concatenate(of), np.bincount(text, minlength=len(at) - 1)


def train(rows: Iterable[tuple[str | None, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over (text, label) rows; the last
    weight is the bias."""
    alpha, beta, l1, l2 = (FTRL[k] for k in ("alpha", "beta", "l1", "l2"))
    dim = 1 << DIM_BITS
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)

    def examples():
        for text, label in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            number, _, count = features(data, np.array([0, len(data)]))
            index, times = np.unique(number, return_counts=True)
            yield np.append(index, dim).astype(np.int32), np.append(times * (SCALE / max(1, count[0])), 1.0).astype(np.float32), float(label)

    held = examples() if epochs == 1 else list(examples())  # one epoch streams
    for _ in range(epochs):
        for index, value, label in held:
            zi, ni = z[index], n[index]
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            root = np.sqrt(ni + g * g)
            z[index] = zi + g - (root - np.sqrt(ni)) / alpha * w
            n[index] = root * root
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def score_texts(column, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(column))
    for i, j, data, at in text_chunks(column):
        number, text, count = features(data, at)
        total = np.bincount(text, weights=weights[number], minlength=j - i)
        out[i:j] = weights[-1] + total * SCALE / np.maximum(count, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def _train_task(batches):
    rows = ((t, y) for batch in batches for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    weights = train(rows)
    at = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(weights[at], pa.float64())], ["feature", "weight"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id_col: str = "doc_id", label_col: str = "quality", eligible=None, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights learnt from at most ``max_rows`` labelled rows, those with the
    smallest hash of their id among ids for which ``eligible(column)`` holds."""
    named = labels.select(F.col(f"`{label_id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    if eligible is not None:
        named = named.filter(eligible(F.col("id")))
    order = F.xxhash64(F.lit("quality"), "id")
    picked = stored(named.groupBy("id").agg(F.max("label").alias("label")).withColumn("order", order).orderBy("order", "id").limit(max_rows), "sample")
    rows = nested_row(docs).select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))
    # Picked ids: max_rows at most.
    sample = rows.join(F.broadcast(picked), "id").dropDuplicates(["id"])
    one = sample.repartition(1).sortWithinPartitions("order", "id").select("text", F.col("label").cast("int").alias("label"))
    weights = np.zeros((1 << DIM_BITS) + 1)
    for row in one.mapInArrow(releasing(_train_task), "feature int, weight double").collect():  # one per weight that isn't 0
        weights[row["feature"]] = row["weight"]
    return weights


def _scored(docs: DataFrame, weights: np.ndarray, text_col: str) -> DataFrame:
    """Columns row (all of ``docs``) and score."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        sole_cache("quality")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(batch.column(1), sent.value))], ["row", "score"])

    rows = nested_row(docs)
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.select("row", F.col("row").getField(text_col).cast("string").alias("text")).mapInArrow(releasing(run), schema)


def score_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score. A column of that name is
    replaced."""
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != score]
    return _scored(docs, weights, text_col).select(*kept, F.col("score").alias(score))


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows that score ``threshold`` or more, as they came."""
    return _scored(docs, weights, text_col).filter(F.col("score") >= threshold).select("row.*")


HELD_OUT_OF = 5
THRESHOLD = 0.3


def _held_out(id_):
    return F.crc32(id_.cast("string").cast("binary")) % HELD_OUT_OF == 0


def trainable(id_):
    """Ids that labels may be learnt from."""
    return ~_held_out(id_)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit_quality(docs, table(spark, sf_dir, "labels"), eligible=trainable)
    scored = score_quality(docs, weights)
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
