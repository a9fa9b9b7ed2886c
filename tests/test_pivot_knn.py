import numpy as np
import pytest

from sparkprep.operators import knn, pivot_knn

SCHEMA = "id long, label long, v array<double>"


def frame(spark, x, labels):
    return spark.createDataFrame([(i, int(labels[i]), x[i].tolist()) for i in range(len(x))], SCHEMA)


def brute(t, q, k):
    out = {}
    for i, x in enumerate(q):
        d = ((t - x) ** 2).sum(axis=1)
        out[i] = sorted(zip(d.round(9).tolist(), range(len(t))))[:k]
    return out


def rows(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.qid, []).append((round(r.dist, 9), r.tid))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("pivots", [None, 1, 60])
def test_exact_against_brute_force(spark, pivots, monkeypatch):
    monkeypatch.setattr(pivot_knn, "PART_TRAIN", 25)
    monkeypatch.setattr(pivot_knn, "PART_QUERIES", 10)
    rng = np.random.default_rng(6)
    centres = rng.normal(scale=8, size=(6, 4))
    t = np.round(centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, 4)))
    t[:100] = t[0]  # a third of the rows are copies: one hot cell, all ties
    q = np.vstack([np.round(centres[rng.integers(0, 6, 40)] + rng.normal(size=(40, 4))), t[:5], rng.normal(scale=50, size=(5, 4)).round()])
    got = pivot_knn.candidates(frame(spark, t, range(300)), frame(spark, q, range(50)), 7, vec="v", n_pivots=pivots)
    assert rows(got) == brute(t, q, 7)


def test_fewer_rows_than_k_and_empty(spark):
    t = np.arange(6.0).reshape(3, 2)
    got = pivot_knn.candidates(frame(spark, t, [1, 1, 2]), frame(spark, t, [0, 0, 0]), 5, vec="v")
    assert rows(got) == brute(t, t, 5)
    none = spark.createDataFrame([], SCHEMA)
    assert pivot_knn.candidates(none, frame(spark, t, [0, 0, 0]), 2, vec="v").count() == 0
    assert pivot_knn.candidates(frame(spark, t, [0, 0, 0]), none, 2, vec="v").count() == 0
    assert pivot_knn.lsh_candidates(none, frame(spark, t, [0, 0, 0]), 2, vec="v").count() == 0


def test_rows_equal_the_block_search(spark):
    rng = np.random.default_rng(9)
    t, labels = rng.normal(size=(200, 5)).round(2), rng.integers(0, 3, 200)
    f = frame(spark, t, labels)
    a = {(r.qid, r.predicted) for r in knn.vote(pivot_knn.candidates(f, f, 9, vec="v"), 9).collect()}
    assert a == {(r.qid, r.predicted) for r in knn.knn_predict(f, f, 9, vec="v").collect()}


def test_only_near_cells_are_visited(spark):
    """Far groups of rows: a query is sent to its own group's cells alone."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    pivots = np.array([[0.0, 0], [1000, 0], [0, 1000]])

    class Sent:
        value = pivots
    q = rng.normal(size=(20, 2))
    batch = pa.RecordBatch.from_pydict({"qid": pa.array(range(20), pa.int64()), "qvec": pa.array(q.tolist()), "own": pa.array([0] * 20, pa.int64()), "bound": pa.array([3.0] * 20)})
    cells = np.zeros(3), np.full(3, 50.0), np.ones(3, bool)
    assert list(pivot_knn._visits(Sent, cells)(iter([batch]))) == []
    near = np.zeros(3), np.full(3, 1500.0), np.ones(3, bool)
    wide = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([2000.0] * 20)], batch.schema.names)
    assert sum(b.num_rows for b in pivot_knn._visits(Sent, near)(iter([wide]))) == 40


def test_hashed_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(scale=3, size=(12, 16))
    t = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 16))
    f = frame(spark, t, rng.integers(0, 2, 600))
    exact = pivot_knn.candidates(f, f, 10, vec="v")
    r = pivot_knn.recall(pivot_knn.lsh_candidates(f, f, 10, vec="v"), exact).agg({"n_exact": "sum", "n_found": "sum"}).first()
    assert r["sum(n_exact)"] == 6000 and r["sum(n_found)"] >= 0.9 * 6000


def test_a_query_is_sent_once_to_a_bin_of_cells(spark):
    """Where no cell can be ruled out, what is sent grows with bins, not with cells."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    pivots = rng.normal(size=(50, 8))

    class Sent:
        value = pivots
    bins = pivot_knn._bins(pivots, np.full(50, pivot_knn.PART_TRAIN // 10))
    assert len(set(bins.tolist())) == 5
    q = pivots[:20]
    batch = pa.RecordBatch.from_pydict({"qid": pa.array(range(20), pa.int64()), "qvec": pa.array(q.tolist()), "own": pa.array(range(20), pa.int64()), "bound": pa.array([None] * 20, pa.float64())})
    sent = [r for b in pivot_knn._visits(Sent, (np.zeros(50), np.full(50, 9.0), np.ones(50, bool)), bins)(iter([batch])) for r in zip(*(b.column(c).to_pylist() for c in ("qid", "grp")))]
    assert len(sent) == len(set(sent)) == 20 * 5


def test_near_pairs_get_exact_distances(monkeypatch):
    """Preselection by rounded products changes neither ties nor order."""
    monkeypatch.setattr(knn, "_Q_STEP", 16)
    monkeypatch.setattr(knn, "_T_STEP", 64)
    compared = []
    squares = knn._squares
    monkeypatch.setattr(knn, "_squares", lambda x, y, i, j: (compared.append(len(i)), squares(x, y, i, j))[1])
    rng = np.random.default_rng(4)
    for scale, offset in [(1.0, 0.0), (1e-5, 1000.0), (1e200, 0.0)]:
        t = rng.normal(size=(300, 6)) * scale + offset
        t[:90] = t[0]
        q, ids = np.vstack([t[::20], t[:1] + scale]), rng.permutation(300).astype(np.int64)
        with np.errstate(over="ignore"):
            i, j, d = knn._nearest(q, t, ids, 7)
            diff = q[:, None] - t[None]
            dist = np.einsum("qtd,qtd->qt", diff, diff)
        want = np.lexsort((np.broadcast_to(ids, dist.shape), dist), axis=1)[:, :7]
        assert (j.reshape(-1, 7) == want).all() and (d.reshape(-1, 7) == np.take_along_axis(dist, want, 1)).all()
        if scale == 1.0:  # few of all pairs are compared exactly
            assert sum(compared) < len(q) * len(t) / 2


def test_rows_that_come_twice_are_one_neighbour(spark):
    """A bin's repeated training rows take no place among the k nearest."""
    rng = np.random.default_rng(8)
    t = rng.normal(size=(60, 3)).round(3)
    f = frame(spark, t, [0] * 60)
    twice = f.unionByName(f.where("id % 2 = 0"))
    assert rows(pivot_knn.candidates(twice, f, 9, vec="v")) == brute(t, t, 9)
