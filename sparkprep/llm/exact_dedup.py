"""Exact deduplication by two passes over a Bloom filter.

Pass one reduces each text to its SHA-256 (after lower-casing A-Z) and sets the
twice-seen Bloom filter from the first 64 bits of the digests. Pass two tests
every digest: rows that cannot be repeated pass straight through, only the
possibly repeated ones shuffle, as (digest, id), and are grouped exactly. The
group of a digest is reduced by partial aggregates, and its members are joined
back to it by an ordinary join of two exchanges, which adaptive execution
splits where one digest is hot.

Defined results: a null text counts as the empty text. Of equal texts the row
with the largest id stays; null ids are smaller than all others. Of rows that
are equal in text and id, exactly one stays. An empty table gives an empty
result. Other columns are never read by :func:`exact_groups` and pass through
:func:`drop_copies` whatever their names are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.llm.bloom import BITS, TwiceSeen, twice_seen
from sparkprep.llm.common import LOWER, bytes_and_offsets, nested_row, releasing, stored, table


def _digests(column) -> pa.Array:
    data, at = bytes_and_offsets(column)
    data = memoryview(np.ascontiguousarray(LOWER[data]))
    sha = hashlib.sha256
    return pa.array([sha(data[at[i]:at[i + 1]]).digest() for i in range(len(at) - 1)], pa.binary())


def _keys(digests) -> np.ndarray:
    """First 64 bits of each digest."""
    data, at = bytes_and_offsets(digests)
    return data.reshape(-1, 32)[:, :8].copy().view(np.uint64).ravel() if len(at) > 1 else np.zeros(0, np.uint64)


def _hash_rows(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _digests(batch.column(1))], ["id", "digest"])


def digest_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per text: id, digest, and ``at``, a key of the row that tells
    rows of equal id and text apart."""
    rows = nested_row(docs)
    two = rows.select(F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).cast("string").alias("text"))
    kind = two.schema["id"].dataType.simpleString()
    hashed = two.mapInArrow(releasing(_hash_rows), f"id {kind}, digest binary")
    return stored(hashed.withColumn("at", F.monotonically_increasing_id()), "digests")


def repeat_filter(digests: DataFrame, bits: int = BITS) -> TwiceSeen:
    return twice_seen(digests.select("digest"), lambda batch: iter([_keys(batch.column(0))]), bits)


def _flag(seen: TwiceSeen):
    def run(batches):
        for batch in batches:
            digests = batch.column(batch.schema.get_field_index("digest"))
            yield batch.append_column("suspect", pa.array(seen.maybe_repeated(_keys(digests))))
    return run


def _flagged(digests: DataFrame, seen: TwiceSeen) -> DataFrame:
    schema = T.StructType([*digests.schema.fields, T.StructField("suspect", T.BooleanType())])
    return digests.mapInArrow(releasing(_flag(seen)), schema)


def _groups(suspects: DataFrame) -> DataFrame:
    """Digests that really repeat, with the row that stays and the size."""
    return stored(suspects.groupBy("digest")
                  .agg(F.max(F.struct("id", "at")).alias("keep"), F.count(F.lit(1)).alias("size"))
                  .filter("size > 1"), "repeated")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per input row: id, digest (binary SHA-256 of the lower-cased
    text), keep_id, group_size, kept."""
    digests = digest_table(docs, id_col, text_col)
    flagged = _flagged(digests, repeat_filter(digests, bits))
    suspects = flagged.filter("suspect")
    groups = _groups(suspects).withColumnRenamed("digest", "key")
    alone = flagged.filter("NOT suspect").select(
        "id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    several = F.col("key").isNotNull()
    checked = suspects.join(groups, F.col("digest") == F.col("key"), "left").select(
        "id", "digest", F.when(several, F.col("keep.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep.at") == F.col("at"), F.lit(True)).alias("kept"))
    return alone.unionByName(checked)


def _hash_nested(id_col: str, text_col: str, seen: TwiceSeen | None):
    def run(batches):
        for batch in batches:
            digests = _digests(batch.column(1))
            out = [batch.column(0), digests, pa.array(seen.maybe_repeated(_keys(digests)))]
            yield pa.RecordBatch.from_arrays(out, ["row", "digest", "suspect"])
    return run


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows that stay, with all their columns. Rows that pass the filter
    go straight through; only suspected ones are moved."""
    digests = digest_table(docs, id_col, text_col)
    seen = repeat_filter(digests, bits)
    groups = _groups(_flagged(digests, seen).filter("suspect")).select(F.col("digest").alias("key"), F.col("keep.id").alias("keep_id"))
    rows = nested_row(docs)
    shown = rows.select("row", F.col("row").getField(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("digest", T.BinaryType()), T.StructField("suspect", T.BooleanType())])
    flagged = shown.mapInArrow(releasing(_hash_nested(id_col, text_col, seen)), schema)
    suspects = flagged.filter("suspect")
    chosen = suspects.join(groups, F.col("digest") == F.col("key"), "left").withColumn("id", F.col("row").getField(id_col))
    unique = chosen.filter("key IS NULL").select("row")
    # Of a group, rows with the id that stays: one, or rows repeated as a whole.
    kept = (chosen.filter(F.col("key").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
            .groupBy("digest").agg(F.first("row").alias("row")).select("row"))
    return flagged.filter("NOT suspect").select("row").unionByName(unique).unionByName(kept).select("row.*")


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
