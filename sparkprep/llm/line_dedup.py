"""Line deduplication with Bloom filters for once-seen and twice-seen lines.

A text is split at ``\\n``; a line's key is the line without ASCII white space
at both ends and with A-Z lower-cased. Keys of at least ``min_chars`` code
points that occur in two documents or more lose all their lines except in the
smallest document that holds them.

Pass one adds each document's distinct keys to the once-seen and twice-seen
planes. Pass two finds, by the twice-seen plane, the lines that may repeat: a
document without any is finished where it is read. Of the others the distinct
suspected keys are shuffled, as SHA-256 with the document's id, and confirmed
exactly by partial aggregates; documents meet the keys they lose by id. A key
that is hot is one row on the side of the confirmed keys, and adaptive
execution splits the other side.

Defined results: a null or empty text is one empty line. Rows that share an id
are one document. A row without id is returned whole and counts for no other
row. Of an empty table the result is empty. Only the two named columns are
read, so other columns and their names don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.bloom import BITS, twice_seen
from sparkprep.llm.common import ASCII_LOWER, ASCII_SPACE, nested_row, stored, table

MIN_CHARS = 10


def _texts(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _key(line: bytes) -> bytes:
    return line.strip(ASCII_SPACE).translate(ASCII_LOWER)


def _long_enough(key: bytes, min_chars: int) -> bool:
    n = len(key)
    if n < min_chars or n >= 4 * min_chars:
        return n >= min_chars
    return len(key.decode("utf-8", "replace")) >= min_chars


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    found = {line.strip(ASCII_SPACE) for line in text.translate(ASCII_LOWER).split(b"\n")}
    return {k for k in found if _long_enough(k, min_chars)}


def _hashes(keys) -> np.ndarray:
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(k) for k in keys), np.uint64)


def _two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = nested_row(docs)
    return rows.select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _find(seen, min_chars):
    """For each document: its suspected keys, and its text while it has any."""
    def run(batches):
        for batch in batches:
            texts, ids, out = _texts(batch.column(1)), batch.column(0), []
            sets = [_keys(t, min_chars) if i.is_valid else () for t, i in zip(texts, ids)]
            flags = seen.maybe_repeated(np.concatenate([np.zeros(0, np.uint64), *map(_hashes, sets)]))
            at = 0
            for text, keys in zip(texts, sets):
                here = [k for k, f in zip(keys, flags[at:at + len(keys)]) if f]
                at += len(keys)
                out.append([hashlib.sha256(k).digest() for k in here])
            open_ = [bool(x) for x in out]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
                pa.array([None if o else t for t, o in zip(texts, open_)], pa.binary()),
                pa.array([t if o else None for t, o in zip(texts, open_)], pa.binary()),
                pa.array(out, pa.list_(pa.binary()))], ["id", "n_lines", "whole", "open", "suspects"])
    return run


def _drop_lines(batches):
    for batch in batches:
        texts, lost = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        dropped, kept = [], []
        for text, keys in zip(texts, lost):
            lines = text.split(b"\n")
            if keys:
                keys = set(keys)
                stay = [x for x in lines if hashlib.sha256(_key(x)).digest() not in keys]
            else:
                stay = lines
            dropped.append(len(lines) - len(stay))
            # A text whose lines are all dropped is empty.
            kept.append(b"\n".join(stay))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())],
                                         ["id", "n_lines", "n_dropped", "kept"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, bits: int = BITS) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept (the text that
    stays, UTF-8 as binary)."""
    two = _two_columns(docs, id_col, text_col)
    kind = two.schema["id"].dataType.simpleString()

    def keys_of(batch):
        for text, i in zip(_texts(batch.column(1)), batch.column(0)):
            if i.is_valid:
                yield _hashes(_keys(text, min_chars))

    seen = twice_seen(two, keys_of, bits)
    found = two.mapInArrow(_find(seen, min_chars), f"id {kind}, n_lines long, whole binary, open binary, suspects array<binary>")
    # Documents without suspected lines are finished here; the rest is kept
    # for the exact part, which reads it twice.
    rest = stored(found.filter("open IS NOT NULL").drop("whole"), "suspects")
    done = found.filter("open IS NULL").select("id", "n_lines", F.lit(0).cast("long").alias("n_dropped"), F.col("whole").alias("kept"))
    held = rest.select("id", F.explode("suspects").alias("key"))
    repeats = stored(held.groupBy("key").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
                     .filter("first_id < last_id").drop("last_id"), "repeats")
    lost = (held.join(repeats, "key").filter("id > first_id")
            .groupBy(F.col("id").alias("doc")).agg(F.collect_set("key").alias("lost")))
    # A document's lost keys are some of its own lines: bounded by its text.
    meet = rest.join(stored(lost, "lost"), F.col("id") == F.col("doc"), "left").select("id", "n_lines", "open", "lost")
    return done.unionByName(meet.mapInArrow(_drop_lines, f"id {kind}, n_lines long, n_dropped long, kept binary"))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > r.first_id, false) AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
