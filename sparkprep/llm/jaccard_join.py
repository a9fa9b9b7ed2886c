"""Near duplicates by n-gram Jaccard similarity, with adaptive multi-match prefixes.

A text's set is its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z
lower-cased; the whole sequence where it has fewer words), as 64-bit hashes. Two
texts link when ``100 * |A & B| >= percent * |A | B|``, and classes are the
connected components of the links.

1. Counts. One pass counts all shingles of all texts at ``2**PLACE_BITS`` places,
   by an ordinary shuffle of (place, count). Places counted once hold a shingle of
   one text only and are dropped; the others go into a sketch of ``2**BITS`` cells,
   broadcast as 2-bit levels of frequency (64 MiB at any input size). So the sketch
   fills with the shingles that repeat, not with all. Levels are never too low, so a
   shingle of level 0 is in one text only. The sketch orders shingles from rare to
   frequent and estimates costs; links never depend on its error.
2. Prefixes. Texts that link share at least l shingles of their first
   ``n - ceil(n * percent / 100) + l`` in that order. Each text takes the l of
   lowest estimated cost: the entries its prefix adds to the lists, plus what
   it costs to verify its candidates, of which there are at most (matches of
   the prefix) / l. A pair is verified only if it shares min(l, l') prefix
   shingles. Shingles of one text only are dropped, and texts whose others
   don't reach ``percent`` of their set link with nothing.
3. Classes of equal sets are reduced to one representative.
4. Stars. Each prefix shingle's list has a pivot, its most central text (highest
   mean frequency of its shingles). Members are verified against their pivots:
   sizes and shared prefix shingles are tested on small rows first (on 16 bits of
   each shingle, so never too few are counted), and only pairs that pass send sets,
   each to the parts of bounded size into which a pivot's members are dealt. What links with the pivot is connected through it, so pairs of such
   texts need no look: a group of near copies costs one comparison a member.
5. Rest. Texts that share a list with a pivot they don't link with are compared
   with the members of that group in blocks of bounded size, by shingles and by
   texts: first shared prefix shingles, then, for the pairs that have enough,
   whole sets, each as matrix products of ``TILE`` texts a side. Texts of one
   size with the same shared shingles have the same links and are compared once
   a block. A block gives a spanning forest of its links, never pairs.
6. Components by alternating large-star and small-star steps on the links.

Every text that links with another shares a list with it, so no link is lost:
it is either verified or its ends are connected through a pivot.

Defined results: a text without words, null included, has an empty set and
links with nothing. Rows that share an id are one document, with the links of
all its texts. A row with a null id gets its n_shingles, a null component, and
takes part in nothing. An empty table gives an empty result. Other columns are
not read, whatever their names are.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import NOT_SPACE, Words, dropped, nested_row, ngram_hashes, releasing, run_once, sole_cache, stored, table, text_chunks

SHINGLE = 5
PERCENT = 75
BITS = 28  # of a cell of the sketch
PLACE_BITS = 36  # of a counted place; a shingle's cell is the first BITS of its place
COUNT_BLOCKS = 10  # bits that name a block of places, which one task adds up
COUNT_TASKS = 64
FLUSH = 1 << 21
ADDED = 1 << 21  # places and counts that a task holds before it adds them up
READ_ROWS = 1 << 10  # texts whose sets are held together
MOST_TIMES = 65535  # that a place is counted
LEVELS = (2, 8, 256)  # texts that a shingle of level 1, 2, 3 is in at least
OTHERS = np.array([0.0, 2.0, 40.0, 1000.0])  # other texts that a level stands for
MOST_MATCHES = 16
VERIFY_COST = 20.0  # of a candidate, in list entries
BLOCK_SHINGLES = 1 << 19  # of a block in step 5; one longer set is a block
BLOCK_TEXTS = 1 << 13  # of a block's side
STAR_TEXTS = 1 << 10  # members of a pivot verified by one part
TILE = 1 << 10  # texts a side of one matrix product
SLICE = 2048


# -- Shingle sets ------------------------------------------------------------------

def shingle_sets(column):
    """The sorted distinct shingle hashes of each text."""
    for i, j, data, at in text_chunks(column):
        words = Words(data, at, NOT_SPACE)
        grams, text = ngram_hashes(words.hashes, words.first, SHINGLE)
        if len(text) > 1 and (text[1:] < text[:-1]).any():
            order = np.argsort(text, kind="stable")
            grams, text = grams[order], text[order]
        cut = np.searchsorted(text, np.arange(j - i + 1))
        for k in range(j - i):
            yield np.unique(grams[cut[k]:cut[k + 1]])


# -- Sketch --------------------------------------------------------------------------

def _cells(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint64(64 - BITS)


def _send(held: list[np.ndarray]):
    """Messages (block, places in it as byte planes of differences, counts), 64 to a batch."""
    at, times = np.unique(np.concatenate(held) >> np.uint64(64 - PLACE_BITS), return_counts=True)
    times = np.minimum(times, MOST_TIMES).astype(np.uint16)
    low_bits = PLACE_BITS - COUNT_BLOCKS
    cuts = np.searchsorted(at, np.arange((1 << COUNT_BLOCKS) + 1, dtype=np.uint64) << np.uint64(low_bits))
    low = (at & np.uint64((1 << low_bits) - 1)).astype(np.uint32)
    blocks = np.flatnonzero(np.diff(cuts))
    for k in range(0, len(blocks), 64):
        some = blocks[k:k + 64]
        ranges = [slice(cuts[b], cuts[b + 1]) for b in some]
        planes = [np.diff(low[r], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() for r in ranges]
        yield pa.RecordBatch.from_pydict({"block": pa.array(some, pa.int32()), "at": pa.array(planes, pa.binary()),
                                          "times": pa.array([times[r].tobytes() for r in ranges], pa.binary())})


def _count(batches):
    held, n = [], 0
    sole_cache("levels", _loaded.clear)
    for batch in batches:
        for grams in shingle_sets(batch.column(0)):
            held.append(grams)
            n += len(grams)
            if n >= FLUSH:
                yield from _send(held)
                held, n = [], 0
    if n:
        yield from _send(held)


def _summed(held: list[np.ndarray]) -> np.ndarray:
    """Places and counts (``place << 16 | count``), one of each place."""
    every = np.concatenate(held)
    every.sort()
    at = every >> np.uint64(16)
    heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    times = np.add.reduceat(every & np.uint64(MOST_TIMES), heads)
    return at[heads] << np.uint64(16) | np.minimum(times, np.uint64(MOST_TIMES))


def _block_levels(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
    """The cells of a block: the highest level of their places, 0 without one that
    was counted twice."""
    sums = _summed(held)
    times = sums & np.uint64(MOST_TIMES)
    level = sum((times >= least).astype(np.uint8) for least in LEVELS)
    cells = np.zeros(1 << (BITS - COUNT_BLOCKS), np.uint8)
    np.maximum.at(cells, (sums[level > 0] >> np.uint64(16 + PLACE_BITS - BITS)).astype(np.int64), level[level > 0])
    packed = zlib.compress((cells[0::4] | cells[1::4] << 2 | cells[2::4] << 4 | cells[3::4] << 6).tobytes(), 1)
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "levels": pa.array([packed], pa.binary())})


def _add_up(batches):
    """Messages sorted by block, added up while they stream in."""
    key, held, n = None, [], 0
    for batch in batches:
        for block, planes, times in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if block != key:
                if key is not None:
                    yield _block_levels(key, held)
                key, held, n = block, [], 0
            at = np.cumsum(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint64)
            held.append(at << np.uint64(16) | np.frombuffer(times, np.uint16))
            n += len(at)
            if n >= ADDED:
                held, n = [_summed(held)], 0
    if key is not None:
        yield _block_levels(key, held)


_loaded: dict[str, np.ndarray] = {}


class Levels:
    """How many of ``LEVELS`` a shingle's count reaches, on executors; 0 means
    that it is in one text only."""

    def __init__(self, spark: SparkSession, planes: list[tuple[int, bytes]]):
        self._sent = spark.sparkContext.broadcast(planes)
        self.key = uuid.uuid4().hex

    def of(self, grams: np.ndarray) -> np.ndarray:
        if self.key not in _loaded:
            _loaded.clear()  # a reused worker keeps the last sketch only
            sole_cache("levels", _loaded.clear)
            plane, size = np.zeros(1 << (BITS - 2), np.uint8), 1 << (BITS - COUNT_BLOCKS - 2)
            for block, packed in self._sent.value:
                plane[block * size:(block + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
            _loaded[self.key] = plane
        at = _cells(grams)
        return _loaded[self.key][at >> np.uint64(2)] >> ((at & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & np.uint8(3)


def count_shingles(texts: DataFrame) -> Levels:
    sent = texts.mapInArrow(releasing(_count), "block int, at binary, times binary")
    # A task adds up its blocks one after another: more tasks for more input.
    tasks = min(1 << COUNT_BLOCKS, max(COUNT_TASKS, sent.rdd.getNumPartitions()))
    dealt = sent.repartition(tasks, "block").sortWithinPartitions("block")
    with run_once(texts.sparkSession):
        # 2**BITS / 4 bytes at most, whatever the input.
        cells = dealt.mapInArrow(releasing(_add_up), "block int, levels binary").collect()
    return Levels(texts.sparkSession, [(r["block"], bytes(r["levels"])) for r in cells])


# -- Prefixes ------------------------------------------------------------------------

def matches_needed(level: np.ndarray, base: int) -> int:
    """The l of lowest estimated cost for shingles of these levels, in order;
    ``base`` + l of them are the prefix."""
    most = min(MOST_MATCHES, len(level) - base)
    entries = np.cumsum(OTHERS[level])[base:base + most]
    return 1 + int(np.argmin(entries * (1 + VERIFY_COST / np.arange(1, most + 1))))


def _row(grams: np.ndarray, level: np.ndarray, percent: int):
    """(shared shingles, prefix, l, centrality) or None if nothing can link."""
    n = len(grams)
    need = -(-percent * n // 100)
    shared = level > 0
    if n == 0 or int(shared.sum()) < need:
        return None
    order = np.lexsort((grams, level))
    base = n - need
    matches = matches_needed(level[order], base)
    prefix = order[:base + matches]
    prefix = prefix[shared[prefix]]
    return grams[shared], grams[prefix], matches, float(level.mean())


def _read(levels: Levels, percent: int):
    def run(batches):
        sole_cache("levels", _loaded.clear)
        for batch in (b.slice(i, READ_ROWS) for b in batches for i in range(0, b.num_rows, READ_ROWS)):
            sets = list(shingle_sets(batch.column(1)))
            every = levels.of(np.concatenate([np.zeros(0, np.uint64), *sets]))
            cut = np.cumsum([0, *map(len, sets)])
            rows = [_row(s, every[cut[k]:cut[k + 1]], percent) for k, s in enumerate(sets)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([None if r is None else r[0].tobytes() for r in rows], pa.binary()),
                pa.array([None if r is None else r[1].view(np.int64) for r in rows], pa.list_(pa.int64())),
                pa.array([None if r is None else r[2] for r in rows], pa.int32()),
                pa.array([None if r is None else r[3] for r in rows], pa.float64()),
                pa.array([None if r is None else _marks(r[1]) for r in rows], pa.binary())],
                ["id", "n", "class", "shared", "prefix", "matches", "central", "marks"])
    return run


# -- Verification ---------------------------------------------------------------------

def _links(both, n, m, percent):
    return 100 * both >= percent * (n + m - both)


def _marks(prefix: np.ndarray) -> bytes:
    """16 bits of each prefix shingle, sorted: two texts share at most as many
    shingles as marks."""
    return np.sort((prefix >> np.uint64(20)).astype(np.uint16)).tobytes()


def shared_marks(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    both = np.intersect1d(x, y)
    times = [np.searchsorted(z, both, "right") - np.searchsorted(z, both) for z in (x, y)]
    return int(np.minimum(*times).sum())


def _able_to_link(percent: int):
    """Rows (pivot, member, sizes, matches and marks of both): whether the sizes and
    the shared prefix shingles allow a link."""
    def run(batches):
        for batch in batches:
            n, m = batch.column("p_n").to_numpy(), batch.column("n").to_numpy()
            least = np.minimum(batch.column("p_matches").to_numpy(), batch.column("matches").to_numpy()).tolist()
            near = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)).tolist()
            marks = zip(near, least, batch.column("p_marks").to_pylist(), batch.column("marks").to_pylist())
            can = [ok and shared_marks(a, b) >= k for ok, k, a, b in marks]
            yield pa.RecordBatch.from_arrays([batch.column("pivot"), batch.column("member"), pa.array(can, pa.bool_())], ["pivot", "member", "able"])
    return run


def _star(percent: int):
    """Rows sorted by (pivot, part), the pivot's own first: whether members link."""
    def run(batches):
        key, hub, size = None, None, 0
        for batch in batches:
            out = []
            for pivot, part, rep, n, shared in zip(*(batch.column(c).to_pylist() for c in ("pivot", "part", "rep", "n", "shared"))):
                grams = np.frombuffer(shared, np.uint64)
                if (pivot, part) != key:
                    key, hub, size = (pivot, part), grams, n
                else:
                    both = len(np.intersect1d(hub, grams, assume_unique=True))
                    out.append((pivot, rep, bool(_links(both, size, n, percent))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()),
                                              pa.array([r[2] for r in out], pa.bool_())], ["pivot", "rep", "linked"])
    return run


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat = [np.concatenate([np.zeros(0, np.uint64), *x]) for x in (a, b)]
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    terms = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    place = [np.searchsorted(terms, f) for f in flat]
    known = [(p < len(terms)) & (terms[np.minimum(p, len(terms) - 1)] == f) if len(terms) else np.zeros(len(f), bool) for p, f in zip(place, flat)]
    for low in range(0, len(terms), SLICE):
        width = min(SLICE, len(terms) - low)
        sides = []
        for x, p, k, r in zip((a, b), place, known, rows):
            here = k & (p >= low) & (p < low + width)
            side = np.zeros((len(x), width), np.float32)
            side[r[here], p[here] - low] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _alike(side) -> list[list]:
    """Texts (id, n, l, prefix, shared) by size and shared shingles: what isn't
    shared is in one text only, so these decide all of a text's links."""
    groups: dict = {}
    for row in side:
        groups.setdefault((row[1], row[4].tobytes()), []).append(row)
    return list(groups.values())


def _tile_links(left, right, percent: int):
    """Numbers of the pairs of rows that link if they are different texts."""
    n, m = (np.array([r[1] for r in side], np.int64) for side in (left, right))
    least = np.minimum.outer(np.array([r[2] for r in left]), np.array([r[2] for r in right]))
    look = 100 * np.minimum.outer(n, m) >= percent * np.maximum.outer(n, m)
    look &= _common([r[3] for r in left], [r[3] for r in right]) >= least
    x, y = np.flatnonzero(look.any(axis=1)), np.flatnonzero(look.any(axis=0))
    if len(x):
        both = _common([left[i][4] for i in x], [right[j][4] for j in y])
        i, j = np.nonzero(look[np.ix_(x, y)] & _links(both, n[x][:, None], m[y][None, :], percent))
        yield from zip(x[i].tolist(), y[j].tolist())


def block_links(left, right, percent: int):
    """Links (id, id) that connect what a block's links connect: a forest.
    left, right: lists of (id, n, l, prefix, shared)."""
    left, right = _alike(left), _alike(right)
    root: dict = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for low in range(0, len(left), TILE):
        for start in range(0, len(right), TILE):
            some, others = left[low:low + TILE], right[start:start + TILE]
            for i, j in _tile_links([g[0] for g in some], [g[0] for g in others], percent):
                # All of one group link with all of the other.
                pairs = [(a[0], others[j][0][0]) for a in some[i]] + [(some[i][0][0], b[0]) for b in others[j][1:]]
                for a, b in pairs:
                    ra, rb = find(a), find(b)
                    if ra != rb:
                        root[ra] = rb
                        yield a, b


def _blocks(percent: int):
    """Rows sorted by (pivot, bx, by): the links of each block pair."""
    def emit(sides):
        found = list(block_links(sides[0], sides[1], percent)) if sides[0] and sides[1] else []
        return [a for a, _ in found], [b for _, b in found]

    def run(batches):
        key, sides, kind = None, ([], []), None
        for batch in batches:
            kind = batch.schema.field("rep").type
            cols = [batch.column(c).to_pylist() for c in ("pivot", "bx", "by", "query", "rep", "n", "matches", "prefix", "shared")]
            us, vs = [], []
            for pivot, bx, by, query, rep, n, matches, prefix, shared in zip(*cols):
                if (pivot, bx, by) != key:
                    u, v = emit(sides)
                    us += u
                    vs += v
                    key, sides = (pivot, bx, by), ([], [])
                sides[0 if query else 1].append((rep, n, matches, np.array(prefix, np.int64).view(np.uint64), np.frombuffer(shared, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(us, kind), pa.array(vs, kind)], ["u", "v"])
        if kind is not None:
            u, v = emit(sides)
            yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])
    return run


# -- Components -----------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of the links (u, v): the smallest id that
    it reaches. Each round is written out; hot vertices are reduced by partial
    aggregates and joined as one row to the split other side."""
    pairs = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = stored(pairs, "links")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
                     .withColumnRenamed("u", "w"), "lowest")
        large = both.join(low, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large-star")
        low = stored(large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "w"), "lowest")
        near = large.join(low, F.col("u") == F.col("w"))
        small = near.select("v", "low").filter("v <> low").union(near.select("u", "low")).toDF("u", "v")
        new = stored(small.distinct(), "small-star")
        # Done when no vertex points to two others and no pointer is followed
        # by another: each component is then a star around its smallest id.
        chains = new.join(new.select(F.col("u").alias("x")).distinct(), F.col("v") == F.col("x"), "left_semi")
        twice = new.groupBy("u").count().filter("count > 1").select("u")
        if chains.select("u").union(twice).isEmpty():
            ends = new.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return ends.union(new.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        pairs = new


# -- Join -----------------------------------------------------------------------------

def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, n_shingles, component."""
    rows = nested_row(docs)
    two = rows.select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    levels = count_shingles(two.filter("id IS NOT NULL").select("text"))
    read = two.mapInArrow(releasing(_read(levels, percent)), f"id {kind}, n long, class binary, shared binary, prefix array<long>, matches int, central double, marks binary")
    whole = stored(read.withColumn("at", F.monotonically_increasing_id()), "sets")
    sets = stored(whole.select("id", "n", "class", "at"), "names")
    usable = sets.filter("id IS NOT NULL AND class IS NOT NULL")
    first = usable.groupBy("class").agg(F.min(F.struct("id", "at")).alias("first"))
    classes = stored(first.select(F.col("class").alias("cls"), F.col("first.id").alias("rep"), F.col("first.at").alias("row")), "classes")
    # Texts that can link, one row of each class.
    able = whole.filter("id IS NOT NULL AND shared IS NOT NULL").join(classes, (F.col("class") == F.col("cls")) & (F.col("at") == F.col("row")))
    able = stored(able.select("class", "n", "shared", "prefix", "matches", "central", "marks"), "able")
    dropped(whole)
    member = F.struct("central", "class").alias("member")
    entries = able.select(F.explode("prefix").alias("token"), member)
    pivots = stored(entries.groupBy("token").agg(F.max("member").alias("pivot"), F.count(F.lit(1)).alias("size"))
                    .filter("size > 1").select("token", F.col("pivot.class").alias("pivot")), "pivots")
    stars = stored(entries.join(pivots, "token").filter("pivot <> member.class").select("pivot", F.col("member.class").alias("member")).distinct(), "stars")
    # Small rows first: sets are sent only for pairs that sizes and matches allow.
    small = stored(able.select(F.col("class").alias("member"), "n", "matches", "marks"), "sizes")
    hub = small.select(F.col("member").alias("hub"), F.col("n").alias("p_n"), F.col("matches").alias("p_matches"), F.col("marks").alias("p_marks"))
    tested = stored(stars.join(small, "member").join(hub, F.col("pivot") == F.col("hub")).drop("hub")
                    .mapInArrow(releasing(_able_to_link(percent)), "pivot binary, member binary, able boolean"), "tested")
    wanted = tested.filter("able").select("pivot", "member")
    # A pivot's members in parts of bounded size; its own set goes to each part once.
    parts = stored(wanted.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / STAR_TEXTS).cast("int").alias("parts")).withColumnRenamed("pivot", "hub"), "parts")
    dealt = wanted.join(parts, F.col("pivot") == F.col("hub")).select(
        "pivot", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("side"), "member")
    own = parts.select(F.col("hub").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"), F.col("hub").alias("member"))
    sets_of = able.select(F.col("class").alias("rep"), "n", "shared")
    pairs = dealt.unionByName(own).join(sets_of, F.col("member") == F.col("rep")).select("pivot", "part", "side", "rep", "n", "shared")
    pairs = pairs.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "side")
    verified = stored(pairs.mapInArrow(releasing(_star(percent)), "pivot binary, rep binary, linked boolean")
                      .unionByName(tested.filter("NOT able").select("pivot", F.col("member").alias("rep"), F.lit(False).alias("linked"))), "verified")

    # Members that don't link with their pivot, against all of its members.
    queries = verified.filter("NOT linked").select("pivot", "rep")
    full = able.select("class", "n", "matches", "prefix", "shared", F.size("prefix").alias("p"))
    size = F.greatest(F.lit(max(1, BLOCK_SHINGLES // BLOCK_TEXTS)), (F.octet_length("shared") / 8).cast("long"))
    load = (verified.join(able.select(F.col("class").alias("rep"), size.alias("size")), "rep").groupBy("pivot")
            .agg(F.sum("size").alias("all"), F.sum(F.when(~F.col("linked"), F.col("size")).otherwise(0)).alias("asked"))
            .filter("asked > 0").select(F.col("pivot").alias("hub"), F.ceil(F.col("all") / BLOCK_SHINGLES).cast("int").alias("ny"),
                                        F.ceil(F.col("asked") / BLOCK_SHINGLES).cast("int").alias("nx")))
    load = stored(load, "load")
    own = F.xxhash64("rep")
    asked = (queries.join(load, F.col("pivot") == F.col("hub"))
             .select("pivot", "rep", F.pmod(own, F.col("nx")).cast("int").alias("bx"), F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("by"), F.lit(True).alias("query")))
    held = (verified.join(load, F.col("pivot") == F.col("hub"))
            .select("pivot", "rep", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("bx"), F.pmod(own, F.col("ny")).cast("int").alias("by"), F.lit(False).alias("query")))
    cells = asked.unionByName(held).join(full, F.col("rep") == F.col("class"))
    cells = cells.select("pivot", "bx", "by", "query", "rep", "n", "matches", "prefix", "shared")
    more = cells.repartition("pivot", "bx", "by").sortWithinPartitions("pivot", "bx", "by").mapInArrow(releasing(_blocks(percent)), "u binary, v binary")

    links = verified.filter("linked").select(F.col("pivot").alias("u"), F.col("rep").alias("v")).unionByName(more)
    name = classes.select("cls", "rep")
    by_id = (links.join(name, F.col("u") == F.col("cls")).select(F.col("rep").alias("u"), "v")
             .join(name, F.col("v") == F.col("cls")).select("u", F.col("rep").alias("v")))
    # Rows of one id with different texts hold the classes of these together.
    shared_id = usable.join(classes, F.col("class") == F.col("cls")).filter("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    own_class = usable.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b").select("id")
    tied = shared_id.join(stored(own_class, "tied"), F.col("u") == F.col("id"), "left_semi")
    found = stored(components(by_id.unionByName(tied)), "components").withColumnRenamed("id", "key")
    named = usable.select("id", "n", "class").join(name, F.col("class") == F.col("cls"))
    out = named.join(found, F.col("rep") == F.col("key"), "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component"))
    rest = sets.filter("id IS NULL OR class IS NULL")
    return out.unionByName(rest.select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of each class's smallest id, and all rows without id or words,
    with all their columns."""
    found = near_classes(docs, id_col, text_col, percent)
    out = stored(found.filter("id <> component").select(F.col("id").alias("lost")).distinct(), "near-copies")
    rows = nested_row(docs)
    return rows.join(out, F.col("row").getField(id_col) == F.col("lost"), "left_anti").select("row.*")


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    found = near_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


OP8_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS r(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
m AS (SELECT s.doc_id, s.g FROM s JOIN f USING (g)),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM m a JOIN m b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 75 * (x.n + y.n - k)),
c AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.v, c.root FROM c JOIN e ON e.u = c.doc_id)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id
FROM c LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
