import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkprep.llm import bloom, common, jaccard_join
from sparkprep.llm.exact_dedup import drop_copies, exact_groups
from sparkprep.llm.jaccard_join import keep_one, near_classes
from sparkprep.llm.line_dedup import dedup_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


# -- exact ------------------------------------------------------------------------

def test_exact_groups_cases(docs):
    rows = [(1, "Ab"), (2, "aB"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 300_000), (7, "x" * 300_000), (None, "ab"), (9, "solo")]
    got = sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in exact_groups(docs(rows)).collect()), key=str)
    want = [(1, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True), (4, 4, 1, True), (5, 6, 2, False), (6, 6, 2, True),
            (7, 7, 2, False), (7, 7, 2, True), (9, 9, 1, True), (None, 2, 3, False)]
    assert got == sorted(want, key=str)
    digests = {r.id: bytes(r.digest).hex() for r in exact_groups(docs(rows)).collect()}
    assert digests[1] == hashlib.sha256(b"ab").hexdigest() and digests[5] == hashlib.sha256(b"").hexdigest()


def test_drop_copies_keeps_columns(docs):
    table = docs([(1, "Ab"), (2, "aB"), (3, None), (3, None), (None, "z"), (4, "w")])
    out = drop_copies(table)
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(2, "aB"), (3, None), (None, "z"), (4, "w")], key=str)
    assert all(r["row"] == "row" and r["kept"] == "kept" for r in out.collect())


def test_exact_empty(docs):
    assert exact_groups(docs([])).collect() == [] and drop_copies(docs([])).collect() == []


def test_exact_when_the_filter_is_full(docs):
    """With far too few bits nearly every row is suspected; nothing changes."""
    rng = random.Random(1)
    rows = [(i, str(rng.randrange(300))) for i in range(600)]
    got = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_groups(docs(rows), bits=8).collect()}
    by = {}
    for i, t in rows:
        by.setdefault(t, []).append(i)
    assert got == {i: (max(by[t]), len(by[t]), i == max(by[t])) for i, t in rows}


def test_filter_merges_in_turns(spark, monkeypatch):
    """No repeat is missed when messages take several turns to merge."""
    import numpy as np
    monkeypatch.setattr(bloom, "FAN_IN", 3)
    values = [(int(i),) for i in range(1000)] + [(i,) for i in range(0, 1000, 7)]
    table = spark.createDataFrame(values, "v long").repartition(11)
    from sparkprep.llm.common import mix
    key = lambda v: mix(np.asarray(v, np.uint64) + np.uint64(12345))
    seen = bloom.twice_seen(table, lambda b: iter([key(b.column(0).to_numpy())]), bits=20)
    found = seen.maybe_repeated(key(np.arange(1000)))
    assert found[::7].all() and found.mean() < 0.2


# -- lines ------------------------------------------------------------------------

def plain_lines(rows, min_chars=10):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    holders = {}
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= min_chars:
                    holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2 or i == min(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_lines_cases(docs):
    rows = [(1, "A shared line\nown\n a SHARED line\t"), (2, "a shared line"), (3, "x\n\x0bA Shared Line\ny"), (4, None), (5, ""),
            (6, "éééééééééé"), (7, "éééééééééé\nshort"), (8, "short"), (None, "a shared line"), (2, "a shared line"),
            (9, "l" * 100_000), (10, "L" * 100_000), (11, "twice here ok\ntwice here ok")]
    got = sorted(((r.id, r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in dedup_lines(docs(rows)).collect()), key=str)
    assert got == plain_lines(rows)
    assert dedup_lines(docs([])).collect() == []


def test_lines_random(docs):
    rng = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"{rng.random()} unique text" for _ in range(rng.randrange(9)))) for i in range(80)]
    got = sorted(((r.id, r.n_lines, r.n_dropped, bytes(r.kept).decode()) for r in dedup_lines(docs(rows), bits=12).collect()), key=str)
    assert got == plain_lines(rows)


# -- near -------------------------------------------------------------------------

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_classes(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def near_rows(seed, groups=4, size=12):
    rng = random.Random(seed)
    passage = " ".join(f"common{k}" for k in range(12))
    texts = []
    for g in range(groups):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(size):
            t = edited(rng, base, rng.randrange(8))
            texts.append(f"{passage} {t}" if rng.random() < 0.4 else t)
    texts += ["one", "ONE", "two words", "", None, " \t", "a b c d e", "A B C D E", "a b c d e f", passage, passage]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_random(docs, seed):
    rows = near_rows(seed)
    got = sorted((r.id, r.n_shingles, r.component) for r in near_classes(docs(rows)).collect())
    assert got == plain_classes(rows)


def test_near_many_blocks(docs, monkeypatch):
    """A group whose members don't link with their pivot, in many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 150)
    rows = near_rows(5, groups=2, size=30)
    got = sorted((r.id, r.n_shingles, r.component) for r in near_classes(docs(rows)).collect())
    assert got == plain_classes(rows)


def test_many_short_texts_that_do_not_link(docs):
    """A hot group of short template texts: every text is asked, few link."""
    n = 20_000
    rows = [(i, f"k{i} this item is no longer available now") for i in range(n)]
    rows += [(n + i, f"k{i} this item is no longer available now or") for i in range(0, 300, 3)]
    got = {r.id: r.component for r in near_classes(docs(rows)).collect()}
    assert got == {i: i % n for i, _ in rows}


def test_blocks_against_pairs_and_in_bounded_memory(monkeypatch):
    import tracemalloc

    import numpy as np
    rng = random.Random(9)

    def text(i, pool, size=6):
        shared = np.array(sorted({1, *rng.sample(range(2, pool), rng.randrange(2, size))}), np.uint64)
        return i.to_bytes(4, "big"), len(shared) + rng.randrange(2), 1, shared[:2], shared

    def classes(names, links):
        root = {v: v for v in names}
        for a, b in links:
            old, new = root[a], root[b]
            root = {k: new if v == old else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == v) for v in root.values()}

    monkeypatch.setattr(jaccard_join, "TILE", 16)
    for pool in (9, 14):
        side = [text(i, pool) for i in range(120)]
        left, right = side[:70], side[40:]
        links = [(a[0], b[0]) for a in left for b in right
                 if a[0] != b[0] and np.intersect1d(a[3], b[3]).size and 100 * (k := np.intersect1d(a[4], b[4]).size) >= 75 * (a[1] + b[1] - k)]
        found = list(jaccard_join.block_links(left, right, 75))
        assert set(found) <= set(links) and len(found) < len(side) and links
        assert classes([r[0] for r in side], found) == classes([r[0] for r in side], links)
    monkeypatch.undo()
    side = [text(i, 10 ** 6) for i in range(5000)]
    tracemalloc.start()
    list(jaccard_join.block_links(side, side, 75))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def test_near_cases(docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " x"), (None, text), (8, "other words here that link with nothing"), (8, text), (9, None)]
    got = sorted(((r.id, r.n_shingles, r.component) for r in near_classes(docs(rows)).collect()), key=str)
    # Row 8 has two texts and so belongs to both classes.
    assert got == sorted([(5, 36, 3), (5, 36, 3), (3, 37, 3), (None, 36, None), (8, 3, 3), (8, 36, 3), (9, 0, 9)], key=str)
    assert near_classes(docs([])).collect() == []
    kept = keep_one(docs(rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, None, 9], key=str)


def test_components_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 8), (3, 3)], "u long, v long")
    got = {r.id: r.component for r in jaccard_join.components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, 8: 7, 9: 7}


def test_prefix_grows_where_it_pays():
    import numpy as np
    assert jaccard_join.matches_needed(np.zeros(40, np.uint8), 10) == 1
    level = np.array([0] * 5 + [2] * 35, np.uint8)
    assert jaccard_join.matches_needed(level, 10) > 1


def test_marks_never_count_too_few_shared_shingles():
    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 300, 4000):
        pool = rng.integers(0, 1 << 63, 2 * n + 1, dtype=np.uint64)
        a, b = (rng.choice(pool, n, replace=False) for _ in range(2))
        shared = len(np.intersect1d(a, b))
        got = jaccard_join.shared_marks(jaccard_join._marks(a), jaccard_join._marks(b))
        assert shared <= got <= min(len(a), len(b))
        assert n > 300 or got == shared


def test_pairs_that_cannot_link_send_no_set():
    columns = {"pivot": [b"p"] * 3, "member": [b"a", b"b", b"c"], "p_n": [100] * 3, "n": [74, 100, 100], "p_matches": [2] * 3, "matches": [2, 3, 2]}
    marks = [jaccard_join._marks(np.array(x, np.uint64) << np.uint64(20)) for x in ([1, 2, 3], [1, 9, 8], [2, 3, 7])]
    batch = pa.RecordBatch.from_pydict(columns | {"p_marks": [marks[0]] * 3, "marks": [marks[0], marks[1], marks[2]]})
    (out,) = jaccard_join._able_to_link(75)(iter([batch]))
    assert out.column("able").to_pylist() == [False, False, True]  # too small; one match of two; both


def test_sketch_fills_with_repeated_shingles_only(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BITS", 12)
    monkeypatch.setattr(jaccard_join, "ADDED", 700)
    rng = np.random.default_rng(5)
    # Ten times as many shingles as cells: of all of them, no cell would stay at 0.
    alone = np.unique(rng.integers(0, 1 << 64, 40_000, dtype=np.uint64))
    twice, often = alone[:100], alone[100:110]
    parts = [alone, twice, *[often] * 300]
    sent = pa.Table.from_batches([b for k in range(0, len(parts), 2) for b in jaccard_join._send(parts[k:k + 2])]).sort_by("block")
    cells = np.zeros(1 << 12, np.uint8)
    for batch in jaccard_join._add_up(iter(sent.to_batches(max_chunksize=50))):
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            flat = np.frombuffer(zlib.decompress(packed), np.uint8)
            cells[block * 4:block * 4 + 4] = (flat[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).ravel()
    level = cells[jaccard_join._cells(alone).astype(np.int64)]
    assert (level[:100] >= 1).all() and (level[100:110] == 3).all()
    assert (level[110:] == 0).mean() > 0.9


def test_near_classes_frees_what_it_wrote(spark, docs):
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(base))
    setting = spark.conf.get(common._FREED)
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1] + ["x"])), (3, " ".join(words[::-1])), (4, None)]
    got = {r.id: r.component for r in near_classes(docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    written = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before}
    assert "able" in written and "sets" not in written  # sets stand in one table only
    assert spark.conf.get(common._FREED) == setting


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffles():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager()
        return {name for name in manager.diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}
    before = shuffles()
    table = common.stored(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "counts")
    assert not shuffles() - before and table.count() == 7
    common.dropped(table)
    assert not os.path.exists(table._stored_at)
