"""From raw documents to token ids: quality filter, exact and near
deduplication, decontamination, encoding.

Each stage takes all rows that the one before kept and returns the columns of
``documents``; the last one returns token ids. :func:`run` writes every stage to
the shared folder and reads it back, so a lost executor repeats one stage at
most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm import exact_dedup, jaccard_join, phrase_index, quality, sentencepiece_nbest
from sparkprep.llm.common import stored, table

# The last stage's workers share an executor with a heap that four stages have
# filled: 131,072 characters and 40,000 remembered words at a time.
PIECE_BYTES = 1 << 17
CACHED_WORDS = 40_000


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"), eligible=quality.trainable)
    return quality.keep_good(docs, weights, threshold=quality.THRESHOLD)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class, keep the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    return phrase_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation of every text, and its n best scores."""
    out = sentencepiece_nbest.encode(docs, piece_bytes=PIECE_BYTES, cached_words=CACHED_WORDS, kept=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "nbest", "decoded_equal")


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_free", benchmark_free),
    ("token_ids", token_ids),
]

# The classifier and the segmentation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
