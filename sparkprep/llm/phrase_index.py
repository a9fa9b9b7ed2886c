"""Benchmark decontamination on a distributed positional inverted index.

:func:`build_index` turns a table of texts into index segments of about
``SEGMENT_WORDS`` words. A segment is one row: the ids and word counts of its
documents, its sorted terms, and the posting list of every term, i.e. the
ascending word positions at which it stands (documents lie one after another
with a gap between them). Segments are written to the shared folder, need no
shuffle, and are searched one by one, whatever splits the table is read in.

:func:`search` takes test windows in blocks, so neither the driver nor a task
holds a whole test set. In each segment a window's terms are ordered by the
length of their posting lists; the rarest list, less the term's offset in the
window, gives candidate starts, which are intersected with the next lists by
vectorised binary search. ``slop`` = 0 gives exact phrases; a larger one gives
proximity matches, in which each word may stand up to ``slop`` words away from
its place.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, known
by a 64-bit hash of their bytes.

Defined results: null and empty texts have no words, and such a test item no
window. A row with a null id is reported like any other. Test items that share
an id are one item; an item without id marks words but isn't listed. Repeated
rows are reported once each. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import ALNUM, Words, bytes_and_offsets, nested_row, releasing, sole_cache, stored, table, text_chunks

SEGMENT_WORDS = 1 << 20
GAP = 64  # positions between documents; more than any slop
BLOCK_WINDOWS = 1 << 16  # test windows searched in one pass
WINDOW = 10


def _pack(values: np.ndarray) -> bytes:
    """Differences of int32 values, low bytes first: close values leave long
    runs of equal bytes, which the file format compresses."""
    return np.diff(values, prepend=np.int32(0)).astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).ravel(), dtype=np.int32)


class _Segment:
    """Documents that are gathered into one row."""

    def __init__(self):
        self.ids, self.keys, self.counts, self.hashes, self.words = [], [], [], [], 0

    def add(self, ids, keys, counts, hashes):
        self.ids.append(ids)
        self.keys.extend(keys)
        self.counts.append(counts)
        self.hashes.append(hashes)
        self.words += len(hashes)

    def row(self, name: str):
        counts = np.concatenate(self.counts)
        starts = np.cumsum(counts + GAP) - counts - GAP
        place = (np.arange(self.words) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)).astype(np.int32)
        hashes = np.concatenate(self.hashes)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
        ids = pa.concat_arrays(self.ids)
        return pa.RecordBatch.from_arrays([
            pa.array([name]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([self.keys], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())),
            pa.array([hashes[new].tobytes()], pa.binary()), pa.array([_pack(np.append(new, len(hashes)).astype(np.int32))], pa.binary()),
            pa.array([_pack(place[order])], pa.binary())], ["segment", "ids", "keys", "n_words", "terms", "cuts", "positions"])


def text_key(data: bytes) -> int:
    """What Spark's xxhash64() gives for a string."""
    h = xxhash.xxh64_intdigest(data, seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def _index(batches):
    task, made, held = TaskContext.get().partitionId(), 0, _Segment()
    sole_cache("phrases")
    for batch in batches:
        for i, j, data, at in text_chunks(batch.column(1)):
            words = Words(data, at, ALNUM)
            raw = memoryview(np.ascontiguousarray(data))
            held.add(batch.column(0).slice(i, j - i), [text_key(raw[at[k]:at[k + 1]]) for k in range(j - i)], words.counts, words.hashes)
            if held.words >= SEGMENT_WORDS:
                yield held.row(f"{task}-{made}")
                made, held = made + 1, _Segment()
    if held.ids:
        yield held.row(f"{task}-{made}")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index segments of all texts, written to the shared folder."""
    rows = nested_row(docs)
    two = rows.select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    return stored(two.mapInArrow(releasing(_index), f"segment string, ids array<{kind}>, keys array<bigint>, n_words array<bigint>, "
                                         "terms binary, cuts binary, positions binary"), "index")


def indexed_docs(index: DataFrame) -> DataFrame:
    """One row per indexed text: segment, place in it, id, key, n_words."""
    docs = F.posexplode(F.arrays_zip("ids", "keys", "n_words")).alias("place", "doc")
    return index.select("segment", docs).select("segment", "place", "doc.*").withColumnRenamed("ids", "id").withColumnRenamed("keys", "key")


# -- Test windows ----------------------------------------------------------------

def _windows(column, n: int):
    """Per text: the word hashes of its windows, padded with 0 to ``n``."""
    data, at = bytes_and_offsets(column)
    words = Words(data, at, ALNUM)
    for k, count in enumerate(words.counts):
        h = words.hashes[words.first[k]:words.first[k + 1]]
        if 0 < count < n:
            yield k, np.pad(h, (0, n - count))[None, :]
        elif count:
            yield k, np.lib.stride_tricks.sliding_window_view(h, n)


def _blocks(items: DataFrame, id_col: str, text_col: str, n: int):
    """Windows of the test items, at most about BLOCK_WINDOWS at a time."""
    rows = nested_row(items).select(F.col("row").getField(id_col).cast("string").alias("id"),
                                    F.col("row").getField(text_col).cast("string").alias("text"))
    held, ids, total = [], [], 0
    for row in rows.toLocalIterator():
        for _, found in _windows(pa.array([row["text"]], pa.string()), n):
            held.append(found)
            ids.extend([row["id"]] * len(found))
            total += len(found)
        if total >= BLOCK_WINDOWS:
            yield np.concatenate(held), ids
            held, ids, total = [], [], 0
    if total:
        yield np.concatenate(held), ids


# -- Search ------------------------------------------------------------------------

def _matches(terms, cuts, positions, windows, slop):
    """(window, start) of all matches in a segment."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms):
        return none
    number = np.searchsorted(terms, windows)
    number[number == len(terms)] = 0
    blank = windows == 0
    known = (terms[number] == windows) | blank
    alive = np.flatnonzero(known.all(axis=1))
    if not len(alive):
        return none
    number, blank = number[alive], blank[alive]
    size = np.where(blank, np.iinfo(np.int64).max, np.diff(cuts)[number])
    order = np.argsort(size, axis=1, kind="stable")  # from the rarest term on
    keys = np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(cuts)) << 32 | positions
    rows = np.arange(len(alive))
    rare = number[rows, order[:, 0]]
    count = cuts[rare + 1] - cuts[rare]
    window = np.repeat(rows, count)
    inside = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    start = positions[np.repeat(cuts[rare], count) + inside].astype(np.int64) - order[window, 0]
    for k in range(1, windows.shape[1]):
        offset = order[window, k]
        goal = number[window, offset] << 32 | np.maximum(start + offset - slop, 0)
        at = np.searchsorted(keys, goal)
        near = keys[np.minimum(at, len(keys) - 1)]
        ok = blank[window, offset] | ((at < len(keys)) & (near >> 32 == number[window, offset]) & ((near & 0xFFFFFFFF) <= start + offset + slop))
        window, start = window[ok], start[ok]
    return alive[window], start


def _search(block, slop):
    def run(batches):
        windows, items = block.value
        lengths = (windows != 0).sum(axis=1)
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            for segment, counts, terms, cuts, packed in zip(*(batch.column(i).to_pylist() for i in range(5))):
                window, start = _matches(np.frombuffer(terms, np.uint64), _unpack(cuts).astype(np.int64), _unpack(packed), windows, slop)
                counts = np.array(counts, np.int64)
                begins = np.cumsum(counts + GAP) - counts - GAP
                place = np.searchsorted(begins, np.maximum(start, 0), side="right") - 1
                first = start - begins[place]
                ends = np.minimum(first + lengths[window], counts[place])
                first = np.maximum(first, 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment] * len(place), pa.string()), pa.array(place, pa.int32()),
                    pa.array([items[w] for w in window], pa.string()), pa.array(window, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(ends, pa.int64())], ["segment", "place", "item_id", "window", "first", "until"])
    return run


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           n: int = WINDOW, slop: int = 0) -> DataFrame:
    """All matches of the items' windows of ``n`` words: segment and place of
    the document, item_id, and the matched words [first, until)."""
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    spark = index.sparkSession
    schema = "segment string, place int, item_id string, window long, first long, until long"
    read = index.select("segment", "n_words", "terms", "cuts", "positions")
    found = [stored(read.mapInArrow(releasing(_search(spark.sparkContext.broadcast(block), slop)), schema), "matches")
             for block in _blocks(items, id_col, text_col, n)]
    out = spark.createDataFrame([], schema)
    for one in found:
        out = out.unionByName(one)
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """One row per text: id, key (xxhash64 of the text), n_words, n_hit,
    item_ids (sorted as strings)."""
    index = build_index(docs, id_col, text_col)
    matches = search(index, items, item_id_col, item_text_col, n)
    # Overlapping windows are cut to what the next one doesn't cover.
    by_doc = matches.groupBy("segment", "place", "first").agg(F.max("until").alias("until"), F.collect_set("item_id").alias("item_ids"))
    per_doc = (by_doc.groupBy("segment", "place")
               .agg(F.array_sort(F.collect_list(F.struct("first", "until"))).alias("spans"),
                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")))
    # Words in the union of the spans, walked in order of their starts.
    union = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct((s["hit"] + F.greatest(F.lit(0), x["until"] - F.greatest(s["end"], x["first"]))).alias("hit"),
                              F.greatest(s["end"], x["until"]).alias("end")),
        lambda s: s["hit"])
    hits = per_doc.select("segment", "place", union.alias("n_hit"), "item_ids")
    return (indexed_docs(index).join(hits, ["segment", "place"], "left")
            .select("id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """The rows in which no item's window occurs, with all their columns."""
    found = contamination(docs, items, id_col, text_col, **named)
    bad = stored(found.filter("n_hit > 0").select(F.col("id").alias("bad_id"), F.col("key").alias("bad_key")), "contaminated")
    rows = nested_row(docs)
    id_, key = F.col("row").getField(id_col), F.xxhash64(F.col("row").getField(text_col).cast("string"))
    return rows.join(bad, id_.eqNullSafe(F.col("bad_id")) & (key == F.col("bad_key")), "left_anti").select("row.*")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, len(w[i:i+9]) AS n, w[i:i+9] AS g
      FROM b, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS r(i)),
sizes AS (SELECT DISTINCT n FROM q),
p AS (SELECT doc_id, i, n, w[i:i+n-1] AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
h AS (SELECT p.doc_id, p.i, p.n, q.item_id FROM p JOIN q USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM h, unnest(range(i, i + n)) AS r(k) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
