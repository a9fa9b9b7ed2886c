"""Sparse encodings: open level dictionaries and the document-term matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators import sparse, textmine
from sparkprep.plans.registry import query
from sparkprep.plans.text_queries import _TERMS_SQL
from sparkprep.sources.tables import table, text_table


def _long(folded, key: str):
    """(key, index, value) of folded rows."""
    entry = F.explode(F.arrays_zip("indices", "values")).alias("e")
    return folded.select(F.col("key").alias(key), entry).select(key, F.col("e.indices").alias("index"), F.col("e.values").alias("value"))


@query("sparse_dummies", """
WITH c AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS level FROM orders WHERE o_custkey IS NOT NULL),
p AS (SELECT DISTINCT o_orderpriority AS level FROM orders WHERE o_orderpriority IS NOT NULL),
ci AS (SELECT level, row_number() OVER (ORDER BY level) AS index FROM c),
pi AS (SELECT level, row_number() OVER (ORDER BY level) + (SELECT count(*) FROM c) AS index FROM p)
SELECT o_orderkey, CAST(0 AS INTEGER) AS index, CAST(o_totalprice AS DOUBLE) AS value FROM orders WHERE o_totalprice <> 0
UNION ALL SELECT o_orderkey, CAST(index AS INTEGER), 1.0::DOUBLE FROM orders JOIN ci ON CAST(o_custkey AS VARCHAR) = level
UNION ALL SELECT o_orderkey, CAST(index AS INTEGER), 1.0::DOUBLE FROM orders JOIN pi ON o_orderpriority = level""")
def sparse_dummies(spark, d):
    """One-hot features over open dictionaries (every customer is a level)."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    levels, _ = sparse.fit_levels(rows, ["o_custkey", "o_orderpriority"], first=1)
    return _long(sparse.fold(sparse.level_entries(rows, "o_orderkey", ["o_totalprice"], levels)), "o_orderkey")


@query("dtm_matrix", f"""{_TERMS_SQL},
dtm AS (SELECT doc_id, term, count(*) AS n FROM f GROUP BY doc_id, term),
v AS (SELECT term, sum(n) AS term_count FROM dtm GROUP BY term ORDER BY term_count DESC, term LIMIT {fv.VOCAB_TERM_MAX}),
i AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS index FROM v)
SELECT doc_id, CAST(index AS INTEGER) AS index, CAST(n AS DOUBLE) AS value FROM dtm JOIN i USING (term)""")
def dtm_matrix(spark, d):
    """Rows of the document-term matrix over the pruned vocabulary."""
    docs = text_table(spark, d, "documents", "doc_id", "text")
    terms = textmine.clean_term_rows(docs, "doc_id", "text")
    vocab = textmine.prune(textmine.word_counts(textmine.clean_term_rows(docs, [], "text"), "term", "term_count"))
    numbers, _ = sparse.number_terms(vocab)
    counts = textmine.doc_term_counts(textmine.restrict(terms, numbers), "doc_id")
    return _long(sparse.fold(sparse.term_entries(docs, "doc_id", counts, numbers)), "doc_id")
