"""Exact k-nearest-neighbour vote (Euclidean) without materialising pairs.

Block nested-loop, fully distributed:

* training rows are hashed into ``T`` chunks and query rows into ``Q`` blocks
  (sizes from two counts, each block bounded in rows);
* every training row is tagged with each query block and every query row
  with each training chunk, so ``cogroup`` on ``(block, chunk)`` brings one
  bounded query block together with one bounded training chunk;
* each cogroup finds near pairs by matrix products and emits only the ``k``
  nearest training rows per query (map-side top-k), by their exact distances
  — never the pairs;
* a final step per query looks at ``T * k`` candidates (bounded), keeps the
  k nearest by (distance, train id) and takes the majority label, ties going
  to the smallest label (deterministic; the original breaks ties at random).

Nothing passes through the driver, and no group is larger than a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK_ROWS = 20_000
TRAIN_CHUNK_ROWS = 50_000
_SCHEMA = "qid long, tid long, dist double, tlabel long"
_Q_STEP, _T_STEP = 512, 4096  # rows compared at a time
_PAIRS = 1 << 16  # whose exact distances are computed at a time


def _squares(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs ``x[i], y[j]``."""
    out = np.empty(len(i))
    for s in range(0, len(i), _PAIRS):
        diff = x[i[s:s + _PAIRS]] - y[j[s:s + _PAIRS]]
        out[s:s + _PAIRS] = np.einsum("nd,nd->n", diff, diff)
    return out


def _first_k(i, d, ids, at, k: int):
    """Of each row number ``i`` the k first pairs by (distance, id)."""
    order = np.lexsort((ids, d, i))
    i = i[order]
    new = np.append(True, i[1:] != i[:-1]) if len(i) else np.zeros(0, bool)
    rank = np.arange(len(i)) - np.maximum.accumulate(np.where(new, np.arange(len(i)), 0)) if len(i) else i
    order = order[rank < k]
    return i[rank < k], d[order], ids[order], at[order]


def _nearest(q: np.ndarray, t: np.ndarray, t_ids: np.ndarray, k: int, limit: np.ndarray | None = None):
    """(query number, training number, squared distance) of the k nearest training rows
    of each query by (distance, id), those beyond its ``limit`` left out.

    A matrix product in single precision, around the training rows' mean, finds what may
    be among the k nearest, with a margin above its rounding error; only these pairs get
    their distance, in double precision. Values that are not finite, or too large for
    single precision, are all compared."""
    mean = t.mean(axis=0)
    with np.errstate(over="ignore", invalid="ignore"):
        qs, ts = (q - mean).astype(np.float32), (t - mean).astype(np.float32)
        qq, tt = (np.einsum("nd,nd->n", x, x, dtype=np.float64) for x in (qs, ts))
    plain = bool(np.isfinite(qq).all() and np.isfinite(tt).all() and max(qq.max(), tt.max()) < 1e30)
    margin = 8.0 * (q.shape[1] + 4) * float(np.finfo(np.float32).eps)
    found = []
    for s in range(0, len(q), _Q_STEP):
        at = slice(s, s + _Q_STEP)
        n = len(q[at])
        bound = np.full(n, np.inf) if limit is None else np.where(np.isnan(limit[at]), np.inf, limit[at])
        best = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for c in range(0, len(t), _T_STEP):
            if plain:
                slack = margin * (qq[at] + tt[c:c + _T_STEP].max()) + 1e-30
                near = qs[at] @ ts[c:c + _T_STEP].T
                near *= -2
                near += tt[c:c + _T_STEP].astype(np.float32)
                shift = bound + slack - qq[at]
                if near.shape[1] > k and not np.isfinite(bound).all():
                    shift = np.minimum(shift, np.partition(near, k - 1, axis=1)[:, k - 1] + 2 * slack)
                i, j = np.nonzero(near <= np.nextafter(shift.astype(np.float32), np.float32(np.inf))[:, None])
            else:
                i, j = (x.ravel() for x in np.indices((n, len(t[c:c + _T_STEP]))))
            if not len(i):
                continue
            d = _squares(q[at], t[c:c + _T_STEP], i, j)
            if limit is not None:
                keep = ~(d > bound[i] * (1 + 1e-9))
                i, j, d = i[keep], j[keep], d[keep]
            best = _first_k(*(np.concatenate(x) for x in zip(best, (i, d, t_ids[c + j], c + j))), k)
            have = np.bincount(best[0], minlength=n)
            last = np.cumsum(have) - 1
            full = have >= k
            bound[full] = np.fmin(bound[full], best[1][last[full]])
        found.append((best[0] + s, best[3], best[1]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _distinct(ids: np.ndarray, mat: np.ndarray) -> np.ndarray:
    """Numbers of the rows without those that repeat an id and its vector."""
    if len(np.unique(ids)) == len(ids):
        return np.arange(len(ids))
    first: dict[tuple, int] = {}
    for n, key in enumerate(zip(ids.tolist(), map(bytes, mat))):
        first.setdefault(key, n)
    return np.array(list(first.values()))


def _topk_fn(k: int, distinct: bool = False):
    """The kernel of a co-group; ``distinct`` counts a training row that comes twice once."""
    def run(q_pdf: pd.DataFrame, t_pdf: pd.DataFrame) -> pd.DataFrame:
        if q_pdf.empty or t_pdf.empty:
            return pd.DataFrame({"qid": [], "tid": [], "dist": [], "tlabel": []})
        q_ids = q_pdf["qid"].to_numpy(dtype=np.int64)
        q_mat = np.vstack(q_pdf["qvec"].to_numpy()).astype(np.float64)
        t_ids = t_pdf["tid"].to_numpy(dtype=np.int64)
        t_lab = t_pdf["tlabel"].to_numpy(dtype=np.int64)
        t_mat = np.vstack(t_pdf["tvec"].to_numpy()).astype(np.float64)
        if distinct:
            kept = _distinct(t_ids, t_mat)
            t_ids, t_lab, t_mat = t_ids[kept], t_lab[kept], t_mat[kept]
        limit = q_pdf["bound"].to_numpy(dtype=np.float64) ** 2 if "bound" in q_pdf else None
        i, j, dist = _nearest(q_mat, t_mat, t_ids, k, limit)
        return pd.DataFrame({"qid": q_ids[i], "tid": t_ids[j], "dist": dist, "tlabel": t_lab[j]})
    return run


def vector_type(df: DataFrame, vec: str) -> str:
    """Single precision is sent as such, anything else as doubles."""
    return "array<float>" if dict(df.dtypes)[vec] == "array<float>" else "array<double>"


def candidates(train: DataFrame, queries: DataFrame, k: int, vec: str = "embedding",
               label: str = "label", train_id: str = "id", query_id: str = "id",
               query_block_rows: int = QUERY_BLOCK_ROWS,
               train_chunk_rows: int = TRAIN_CHUNK_ROWS) -> DataFrame:
    """(qid, tid, dist, tlabel): the k nearest training rows of each query
    within each training chunk."""
    spark = train.sparkSession
    n_t, n_q = train.count(), queries.count()
    par = spark.sparkContext.defaultParallelism
    n_blocks = max(1, -(-n_q // query_block_rows))
    # Chunks are replicated and each sends k rows a query: no more than the cores need.
    n_chunks = max(1, min(n_t, max(-(-n_t // train_chunk_rows), -(-par // n_blocks))))
    t = train.select(F.col(train_id).cast("long").alias("tid"), F.col(label).cast("long").alias("tlabel"),
                     F.col(vec).cast(vector_type(train, vec)).alias("tvec"))
    t = t.withColumn("chunk", F.pmod(F.xxhash64("tid"), F.lit(n_chunks)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    q = queries.select(F.col(query_id).cast("long").alias("qid"),
                       F.col(vec).cast(vector_type(queries, vec)).alias("qvec"))
    q = q.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(n_blocks)).cast("int")) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    # One task per (block, chunk) group, up to the cluster's shuffle width.
    # An explicit partition count is kept by AQE (it would otherwise merge the
    # small shuffle blocks and serialise the CPU-bound groups into one task).
    groups = n_blocks * n_chunks
    width = max(par, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    n_parts = max(1, min(groups, width))
    gid = (F.col("block") * F.lit(n_chunks) + F.col("chunk")).alias("gid")
    t = t.select("*", gid).repartition(n_parts, "gid")
    q = q.select("*", gid).repartition(n_parts, "gid")
    return (q.groupBy("gid")
            .cogroup(t.groupBy("gid"))
            .applyInPandas(_topk_fn(k), _SCHEMA))


def vote(cands: DataFrame, k: int) -> DataFrame:
    """Majority label of the k nearest candidates per query."""
    near = cands.withColumn("__r", F.row_number().over(
        Window.partitionBy("qid").orderBy("dist", "tid"))).where(F.col("__r") <= k)
    votes = near.groupBy("qid", "tlabel").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy("qid").orderBy(F.desc("__c"), F.asc("tlabel"))
    return (votes.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1)
            .select("qid", F.col("tlabel").alias("predicted")))


def knn_predict(train: DataFrame, queries: DataFrame, k: int, **kw) -> DataFrame:
    """(qid, predicted) for every query row."""
    return vote(candidates(train, queries, k, **kw), k)
