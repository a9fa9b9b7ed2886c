"""Nearest neighbours by groups: exact over pivot cells, approximate over hashed ones.

Exact (:func:`candidates`). Training rows go to the cell of their nearest pivot, so each
is sent once however many queries there are. A query first meets its own cell, which
bounds the distance of its k-th neighbour; after that it visits only cells that can
hold a nearer row: by the triangle inequality with the cell's least and largest
distance to its pivot, and by its distance to the plane between the two pivots. Cells
are visited in bins of neighbouring cells, so a query is sent once to a bin. Pivots
are at most ``MAX_PIVOTS`` training rows (those with the smallest hash of their id,
about the square root of their number), so they and the cells' radii are bounded.

Approximate (:func:`lsh_candidates`). Rows of one bucket of a table of random
projections meet; ``tables`` tables make up for neighbours that a cut separates. The
recall is measured against the exact search, not assumed.

Both bring queries and training rows together in groups cut into parts of bounded size
on both sides, and a part sends on only the k nearest of each query: no pair is ever
written, and a cell or bucket that holds a third of all rows is many parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.operators.knn import _SCHEMA, _topk_fn, vector_type
from sparkprep.session import materialize, shuffle_partitions

MAX_PIVOTS = 1 << 10
PART_TRAIN = 20_000
PART_QUERIES = 20_000
SLACK = 1e-9  # relative; bounds are rounded, ties at a bound must be seen


def _rows(df: DataFrame, id_col: str, vec: str, prefix: str, label: str | None = None) -> DataFrame:
    cols = [F.col(id_col).cast("long").alias(prefix + "id")]
    cols += [F.col(label).cast("long").alias("tlabel")] if label else []
    return df.select(*cols, F.col(vec).cast(vector_type(df, vec)).alias(prefix + "vec"))


def _matrix(column) -> np.ndarray:
    """Rows of a list column; of one length, without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(y)))
    step = max(1, (1 << 22) // max(1, y.size))
    for i in range(0, len(x), step):
        diff = x[i:i + step, None, :] - y[None]
        out[i:i + step] = np.sqrt(np.einsum("qtd,qtd->qt", diff, diff))
    return out


def grouped_topk(train: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qid, tid, dist, tlabel): the k nearest of each query in each part of its
    groups. ``train`` (grp, tid, tlabel, tvec) and ``queries`` (grp, qid, qvec)."""
    sizes = train.groupBy("grp").agg(F.count(F.lit(1)).alias("nt")).join(queries.groupBy("grp").agg(F.count(F.lit(1)).alias("nq")), "grp")
    sizes = materialize(sizes.select(F.col("grp").alias("g"), F.ceil(F.col("nt") / PART_TRAIN).cast("int").alias("pt"),
                                     F.ceil(F.col("nq") / PART_QUERIES).cast("int").alias("pq")))

    def dealt(df, own, mine, other, key):
        part = F.pmod(F.xxhash64(key), F.col(mine)).cast("int")
        cut = df.join(sizes, F.col("grp") == F.col("g"))
        cut = cut.withColumn(own, part).withColumn("o", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, j = (own, "o") if own == "i" else ("o", own)
        return cut.withColumn("gid", F.struct("g", F.col(i).alias("i"), F.col(j).alias("j"))).drop("g", "grp", "pt", "pq", "i", "j", "o")
    t, q = dealt(train, "i", "pt", "pq", "tid"), dealt(queries, "j", "pq", "pt", "qid")
    parts = max(shuffle_partitions(train.sparkSession), train.sparkSession.sparkContext.defaultParallelism)
    t, q = (df.repartition(parts, "gid") for df in (t, q))
    return q.groupBy("gid").cogroup(t.groupBy("gid")).applyInPandas(_topk_fn(k, distinct=True), _SCHEMA)


def nearest(cands: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query among candidates, by (dist, tid), each once. A query
    has k candidates for each part that it visited."""
    from pyspark.sql import Window
    # A pair that comes twice has one rank, so one shuffle by query serves both steps.
    rank = F.dense_rank().over(Window.partitionBy("qid").orderBy("dist", "tid"))
    return cands.withColumn("__r", rank).where(F.col("__r") <= k).dropDuplicates(["qid", "tid"]).drop("__r")


def pivots_of(train: DataFrame, n: int | None = None) -> np.ndarray:
    """At most ``MAX_PIVOTS`` distinct training vectors."""
    n = n or min(MAX_PIVOTS, max(1, math.isqrt(train.count())))
    rows = train.orderBy(F.xxhash64(F.lit("pivot"), "tid"), "tid").limit(n).select("tvec").collect()
    return np.unique(np.array([r["tvec"] for r in rows], float), axis=0) if rows else np.zeros((0, 0))


def _assign(sent, vec: str):
    """Rows with their nearest pivot (grp) and its distance (r)."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index(vec)))
            cell, r = np.zeros(0, np.int64), np.zeros(0)
            if len(x):
                d = _distances(x, sent.value)
                cell = d.argmin(axis=1)
                r = d[np.arange(len(x)), cell]
            yield batch.append_column("grp", pa.array(cell, pa.int64())).append_column("r", pa.array(r, pa.float64()))
    return run


def _visits(sent, cells, bins: np.ndarray | None = None):
    """(grp, qid, qvec, bound), once for each bin (of ``bins``: cell -> bin; each cell
    by itself if none) with another cell that may hold a row as near as ``bound``."""
    def run(batches):
        pivots, (low, high, full) = sent.value, cells
        between = _distances(pivots, pivots)
        of = np.arange(len(pivots)) if bins is None else bins
        order = np.argsort(of, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(of[order]) != 0))
        for batch in batches:
            x = _matrix(batch.column("qvec"))
            if not len(x):
                continue
            own, bound = batch.column("own").to_numpy(), batch.column("bound").to_numpy(zero_copy_only=False)
            d = _distances(x, pivots)
            mine = d[np.arange(len(x)), own]
            gap = between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(gap > 0, (d ** 2 - mine[:, None] ** 2) / (2 * gap), 0.0)
            least = np.maximum(np.maximum(d - high, low - d), plane)
            scale = SLACK * (1 + d + np.where(np.isfinite(high), high, 0.0))
            go = full & ((least <= bound[:, None] + scale) | np.isnan(bound)[:, None])
            go[np.arange(len(x)), own] = False
            i, at = np.nonzero(np.logical_or.reduceat(go[:, order], heads, axis=1))
            grp = of[order[heads[at]]]
            for s in range(0, len(i), 1 << 14):
                rows = pa.array(i[s:s + (1 << 14)])
                yield pa.RecordBatch.from_arrays([pa.array(grp[s:s + (1 << 14)], pa.int64()), *(batch.column(c).take(rows) for c in ("qid", "qvec", "bound"))],
                                                 ["grp", "qid", "qvec", "bound"])
    return run


def _bins(pivots: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cell -> bin: cells that lie side by side along the pivots' widest direction,
    ``PART_TRAIN`` rows together; a larger cell is a bin by itself. A query is sent to a
    bin once however many of its cells it visits, so what is sent is bounded by queries x
    bins where no cell can be ruled out."""
    away = pivots - pivots.mean(axis=0)
    order = np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")
    out, bin_, held = np.zeros(len(pivots), np.int64), 0, 0
    for cell in order.tolist():
        if held and held + sizes[cell] > PART_TRAIN:
            bin_, held = bin_ + 1, 0
        out[cell] = bin_
        held += int(sizes[cell])
    return out


def candidates(train: DataFrame, queries: DataFrame, k: int, vec: str = "embedding", label: str = "label",
               train_id: str = "id", query_id: str = "id", n_pivots: int | None = None) -> DataFrame:
    """(qid, tid, dist, tlabel): the k nearest training rows of each query, exactly."""
    spark = train.sparkSession
    t, q = _rows(train, train_id, vec, "t", label), _rows(queries, query_id, vec, "q")
    pivots = pivots_of(t, n_pivots)
    if not len(pivots):
        return spark.createDataFrame([], _SCHEMA)
    sent = spark.sparkContext.broadcast(pivots)  # MAX_PIVOTS rows at most
    kind, asked_kind = vector_type(t, "tvec"), vector_type(q, "qvec")
    t = materialize(t.mapInArrow(_assign(sent, "tvec"), f"tid long, tlabel long, tvec {kind}, grp long, r double"))
    low, high, full = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots), bool)
    sizes = np.zeros(len(pivots), np.int64)
    for row in t.groupBy("grp").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count(F.lit(1)).alias("n")).collect():  # one row per pivot
        low[row["grp"]], high[row["grp"]], full[row["grp"]], sizes[row["grp"]] = row["low"], row["high"], True, row["n"]
    q = materialize(q.mapInArrow(_assign(sent, "qvec"), f"qid long, qvec {asked_kind}, grp long, r double").drop("r"))
    cells = t.select("grp", "tid", "tlabel", "tvec")
    first = materialize(nearest(grouped_topk(cells, q, k), k))
    # dist is squared; a query with fewer than k rows in its cell has no bound yet.
    bound = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.sqrt(F.max("dist"))).alias("bound")).withColumnRenamed("qid", "b")
    asked = q.join(bound, F.col("qid") == F.col("b"), "left").select("qid", "qvec", F.col("grp").alias("own"), "bound")
    bins = _bins(pivots, sizes)
    others = materialize(asked.mapInArrow(_visits(sent, (low, high, full), bins), f"grp long, qid long, qvec {asked_kind}, bound double"))
    of = F.element_at(F.array(*[F.lit(int(b)).cast("long") for b in bins]), (F.col("grp") + 1).cast("int"))
    return nearest(first.unionByName(grouped_topk(cells.withColumn("grp", of), others, k)), k)


def lsh_candidates(train: DataFrame, queries: DataFrame, k: int, vec: str = "embedding", label: str = "label",
                   train_id: str = "id", query_id: str = "id", tables: int = 24, bits: int = 4, seed: int = 7) -> DataFrame:
    """(qid, tid, dist, tlabel): of each query, the k nearest training rows that share
    a bucket with it in one of ``tables`` tables. A bucket is the signs of ``bits``
    random projections of the row less the mean of the training rows."""
    spark = train.sparkSession
    t, q = _rows(train, train_id, vec, "t", label), _rows(queries, query_id, vec, "q")
    dims = t.select(F.size("tvec").alias("d")).first()
    if dims is None:
        return spark.createDataFrame([], _SCHEMA)
    mean = np.array(t.agg(*[F.avg(F.col("tvec")[i]) for i in range(dims["d"])]).first(), float)
    planes = np.random.default_rng(seed).normal(size=(dims["d"], tables * bits))

    def buckets(vec):
        def run(batches):
            for batch in batches:
                x = _matrix(batch.column(batch.schema.get_field_index(vec)))
                if not len(x):
                    continue
                sign = ((x - mean) @ planes > 0).reshape(len(x), tables, bits)
                code = (sign << np.arange(bits)).sum(axis=2) + (np.arange(tables) << bits)
                at = pa.array(np.repeat(np.arange(len(x)), tables))
                yield pa.RecordBatch.from_arrays([pa.array(code.ravel(), pa.int64()), *(c.take(at) for c in batch.columns)], ["grp", *batch.schema.names])
        return run
    t = t.mapInArrow(buckets("tvec"), f"grp long, tid long, tlabel long, tvec {vector_type(t, 'tvec')}")
    q = q.mapInArrow(buckets("qvec"), f"grp long, qid long, qvec {vector_type(q, 'qvec')}")
    return nearest(grouped_topk(t, q, k), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(qid, n_exact, n_found): how many of a query's exact neighbours were found."""
    hit = exact.select("qid", "tid").join(found.select("qid", "tid", F.lit(1).alias("hit")), ["qid", "tid"], "left")
    return hit.groupBy("qid").agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"))
