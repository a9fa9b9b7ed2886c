"""Text mining: word rows, word frequencies, vocabularies with term and
document counts, pruning, document-term counts (long form) and term totals.

Tokens are exploded from whole texts; every count is a map-side-combined
aggregate, so a very frequent word (or a very long document) is reduced per
task before any shuffle. The pruned vocabulary has a fixed size bound and is
the only table that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions.text import clean_tokens, word_tokens


def unnest_tokens(df: DataFrame, col: str, out: str = "word", keep=()) -> DataFrame:
    """One row per word token (lower-cased, punctuation split off)."""
    return df.select(*keep, F.explode(word_tokens(col)).alias(out))


def word_counts(tokens: DataFrame, word: str = "word", name: str = "n") -> DataFrame:
    return tokens.groupBy(word).agg(F.count(F.lit(1)).alias(name))


def clean_term_rows(df: DataFrame, keep, text_col: str,
                    stop_words=fv.ENGLISH_STOP_WORDS, out: str = "term") -> DataFrame:
    """(doc, term) rows from the cleaning tokenizer (duplicates kept);
    ``keep`` names the document column(s) carried along."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    return df.select(*keep, F.explode(clean_tokens(text_col, list(stop_words))).alias(out))


def doc_term_counts(terms: DataFrame, doc_cols, term: str = "term",
                    name: str = "n") -> DataFrame:
    """Long document-term matrix: (doc, term, n)."""
    doc_cols = [doc_cols] if isinstance(doc_cols, str) else list(doc_cols)
    return terms.groupBy(*doc_cols, term).agg(F.count(F.lit(1)).alias(name))


def vocabulary(dtm: DataFrame, term: str = "term", n: str = "n") -> DataFrame:
    """(term, term_count, doc_count) from a long document-term table."""
    return dtm.groupBy(term).agg(F.sum(n).alias("term_count"),
                                 F.count(F.lit(1)).alias("doc_count"))


def prune(vocab: DataFrame, max_terms: int = fv.VOCAB_TERM_MAX,
          term: str = "term") -> DataFrame:
    """Keep the ``max_terms`` most frequent terms (ties by term), as a
    distributed top-k (at most ``max_terms`` rows leave each task)."""
    return vocab.orderBy(F.desc("term_count"), F.asc(term)).limit(max_terms)


def top_vocabulary(df: DataFrame, text_col: str, max_terms: int = fv.VOCAB_TERM_MAX,
                   stop_words=fv.ENGLISH_STOP_WORDS) -> DataFrame:
    """(term, term_count, doc_count) of the ``max_terms`` most frequent terms:
    terms are counted and pruned first, and only the kept ones are counted by
    document, so no exchange is keyed by (document, term)."""
    toks = df.select(clean_tokens(text_col, list(stop_words)).alias("__t"))
    kept = prune(word_counts(toks.select(F.explode("__t").alias("term")), "term", "term_count"), max_terms)
    held = restrict(toks.select(F.explode(F.array_distinct("__t")).alias("term")), kept)
    # At most ``max_terms`` rows on both sides.
    return kept.join(held.groupBy("term").agg(F.count(F.lit(1)).alias("doc_count")), "term")


def restrict(dtm: DataFrame, vocab: DataFrame, term: str = "term") -> DataFrame:
    """Document-term counts limited to a pruned vocabulary (broadcast: the
    vocabulary must come from :func:`prune`, whose limit bounds its size)."""
    return dtm.join(F.broadcast(vocab.select(term)), term, "inner")


def term_totals(dtm: DataFrame, term: str = "term", n: str = "n") -> DataFrame:
    """Column sums of the document-term matrix and the number of documents
    each term occurs in."""
    return vocabulary(dtm, term, n)
