"""Word tables, stop-word removal, document-term counts, vocabularies and
multi-value list encodings over whole documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions.text import list_tokens, word_tokens
from sparkprep.operators import agg, join, multi, split, textmine
from sparkprep.operators.impute import fill_tokens
from sparkprep.plans.registry import q, query, sql_list
from sparkprep.sources.tables import table, text_table

STOP_SQL = sql_list(fv.ENGLISH_STOP_WORDS)
WORDS_SQL = r"regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}'']+')"
CLEAN_SQL = (r"regexp_split_to_array(regexp_replace(regexp_replace(lower({c}), '[0-9]', '', 'g'),"
             r" '[[:punct:]]', '', 'g'), '[^\p{{L}}\p{{N}}]+')")


def _stop_words(spark):
    return spark.createDataFrame([(w,) for w in fv.ENGLISH_STOP_WORDS], "word string")


def _kept_words(spark, words):
    """Word counts without stop words (broadcast anti-join: fixed list) and
    without tokens containing digits."""
    counts = textmine.word_counts(words)
    kept = join.anti(counts, _stop_words(spark), "word", small=True)
    return counts, kept.where(~F.col("word").rlike(r"\d"))


@query("stopword_antijoin", f"""
WITH w AS (SELECT unnest({WORDS_SQL.format(c='text')}) AS word FROM documents),
c AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word)
SELECT word, CAST(n AS BIGINT) AS n,
  CASE WHEN word IN {sql_list(fv.SPACE_KEYWORDS)} THEN 'Yes' ELSE 'No' END AS has_space_features,
  CAST((SELECT sum(n) FROM c) AS BIGINT) AS total
FROM c WHERE word NOT IN {STOP_SQL} AND NOT regexp_matches(word, '\\d')""")
def stopword_antijoin(spark, d):
    docs = text_table(spark, d, "documents")
    # The total is the sum of the per-word counts; both branches reuse their
    # exchange, so every text is tokenised once.
    counts = textmine.word_counts(textmine.unnest_tokens(docs, "text"))
    total = counts.agg(F.sum("n").alias("n")).select("n").scalar()
    kept = join.anti(counts, _stop_words(spark), "word", small=True) \
        .where(~F.col("word").rlike(r"\d"))
    flag = F.when(F.col("word").isin(*fv.SPACE_KEYWORDS), "Yes").otherwise("No")
    return kept.select("word", "n", flag.alias("has_space_features"), total.alias("total"))


@query("token_filters", f"""
WITH w AS (SELECT unnest({WORDS_SQL.format(c='t')}) AS word
           FROM (SELECT CASE WHEN turn % 4 = 3 THEN NULL ELSE text END AS t FROM conversations) s
           WHERE t IS NOT NULL)
SELECT word, CAST(count(*) AS BIGINT) AS n FROM w
WHERE word <> '' AND NOT regexp_matches(word, '\\d')
GROUP BY word ORDER BY n DESC, word LIMIT 10""")
def token_filters(spark, d):
    conv = text_table(spark, d, "conversations")
    t = F.when(F.col("turn") % 4 == 3, F.lit(None)).otherwise(F.col("text"))
    present = conv.select(t.alias("t")).where(F.col("t").isNotNull())
    words = textmine.unnest_tokens(present, "t").where(~F.col("word").rlike(r"\d"))
    return agg.top_k(textmine.word_counts(words), 10, [F.desc("n"), F.asc("word")])


@query("space_membership", f"""
WITH w AS (SELECT unnest({WORDS_SQL.format(c='text')}) AS word FROM documents),
v AS (SELECT DISTINCT word FROM w WHERE word <> '' AND word NOT IN {STOP_SQL}
      AND NOT regexp_matches(word, '\\d'))
SELECT d.doc_id, CASE WHEN v.word IS NOT NULL THEN 'Yes' ELSE 'No' END AS has_space_features
FROM documents d LEFT JOIN v ON d.lang = v.word""")
def space_membership(spark, d):
    docs = text_table(spark, d, "documents")
    _, kept = _kept_words(spark, textmine.unnest_tokens(docs, "text"))
    flagged = join.flag(docs.select("doc_id", "lang"), kept, "lang", "word",
                        "has_space_features")
    return flagged.select("doc_id", "has_space_features")


_TERMS_SQL = f"""WITH t AS (SELECT doc_id, unnest({CLEAN_SQL.format(c='text')}) AS term FROM documents),
f AS (SELECT doc_id, term FROM t WHERE term <> '' AND term NOT IN {STOP_SQL})"""


@query("dtm_topterms", f"""{_TERMS_SQL},
dtm AS (SELECT doc_id, term, count(*) AS n FROM f GROUP BY doc_id, term),
v AS (SELECT term, sum(n) AS term_count, count(*) AS doc_count FROM dtm GROUP BY term
      ORDER BY term_count DESC, term LIMIT {fv.VOCAB_TERM_MAX})
SELECT term, CAST(term_count AS BIGINT) AS term_count, CAST(doc_count AS BIGINT) AS doc_count FROM v""")
def dtm_topterms(spark, d):
    docs = text_table(spark, d, "documents")
    return textmine.top_vocabulary(docs, "text")


_SPLIT_SQL = """SELECT doc_id, row_number() OVER (ORDER BY md5('{seed}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
             count(*) OVER () AS cnt FROM documents"""


@query("dtm_train_vocab", f"""{_TERMS_SQL},
r AS ({_SPLIT_SQL.format(seed=fv.SPLIT_SEED)}),
s AS (SELECT doc_id, rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE) AS is_valid FROM r),
dtm AS (SELECT f.doc_id, term, count(*) AS n, any_value(s.is_valid) AS is_valid
        FROM f JOIN s ON f.doc_id = s.doc_id GROUP BY f.doc_id, term),
v AS (SELECT term, sum(n) AS term_count FROM dtm WHERE NOT is_valid GROUP BY term
      ORDER BY term_count DESC, term LIMIT {fv.VOCAB_TERM_MAX})
SELECT doc_id, dtm.term, CAST(n AS BIGINT) AS n FROM dtm JOIN v ON dtm.term = v.term WHERE is_valid""")
def dtm_train_vocab(spark, d):
    docs = split.holdout(text_table(spark, d, "documents").select("doc_id", "text"),
                         fv.VALID_FRACTION, fv.SPLIT_SEED, "doc_id", "is_valid")
    train = textmine.clean_term_rows(docs.where(~F.col("is_valid")), [], "text")
    train_vocab = textmine.prune(textmine.word_counts(train, "term", "term_count"))
    valid = textmine.clean_term_rows(docs.where("is_valid"), "doc_id", "text")
    return textmine.doc_term_counts(textmine.restrict(valid, train_vocab), "doc_id")


# ----------------------------------------------------------- list columns
_LIST_SPARK_TOKENS = ["af", "ao", "nf", "no", "rf", "ro"]
_LIST_SQL = """WITH l AS (SELECT l_orderkey AS k,
      array_to_string(list_sort(list_distinct(list(' ' || l_returnflag || '-' || l_linestatus || '.'))), ',') AS txt
    FROM lineitem GROUP BY l_orderkey),
b AS (SELECT k, CASE WHEN k % 10 = 0 THEN NULL ELSE txt END AS txt FROM l),
t AS (SELECT k, list_transform(string_split(txt, ','),
        lambda x: trim(lower(regexp_replace(x, '[[:punct:]]', '', 'g')), ' ' || chr(9) || chr(13) || chr(10))) AS toks FROM b)"""


def _order_lists(spark, d):
    li = table(spark, d, "lineitem")
    per = (li.groupBy("l_orderkey")
           .agg(F.array_join(F.array_sort(F.collect_set(
               F.concat(F.lit(" "), F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"),
                        F.lit(".")))), ",").alias("txt")))
    return per.select(F.col("l_orderkey").alias("k"),
                      F.when(F.col("l_orderkey") % 10 == 0, F.lit(None))
                      .otherwise(F.col("txt")).alias("txt"))


_hot_sql = ",\n  ".join(
    f"CAST(coalesce(list_contains(toks2, {q(t)}), false) AS INTEGER) AS has_{t}"
    for t in [*_LIST_SPARK_TOKENS, fv.MISSING_TOKEN])


@query("multi_hot", f"""{_LIST_SQL},
u AS (SELECT k, CASE WHEN toks IS NULL THEN [{q(fv.MISSING_TOKEN)}]
                 ELSE list_transform(toks, lambda x: coalesce(x, {q(fv.MISSING_TOKEN)})) END AS toks2 FROM t)
SELECT k AS l_orderkey,
  {_hot_sql},
  CAST(len(list_distinct(toks2)) AS BIGINT) AS n_tokens
FROM u""")
def multi_hot(spark, d):
    lists = _order_lists(spark, d)
    toks = lists.select(F.col("k").alias("l_orderkey"),
                        fill_tokens(list_tokens("txt"), fv.MISSING_TOKEN).alias("toks"))
    toks = toks.withColumn("n_tokens", F.size(F.array_distinct("toks")).cast("long"))
    return multi.one_hot(toks, "toks", [*_LIST_SPARK_TOKENS, fv.MISSING_TOKEN], prefix="has_")


@query("list_vocabulary", f"""{_LIST_SQL},
e AS (SELECT k, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM t WHERE toks IS NOT NULL),
f AS (SELECT token, arg_min(k, (k, pos)) AS first_row, arg_min(pos, (k, pos)) AS first_pos FROM e GROUP BY token)
SELECT token, first_row, CAST(first_pos AS INTEGER) AS first_pos,
       row_number() OVER (ORDER BY first_row, first_pos) AS vocab_idx FROM f""")
def list_vocabulary(spark, d):
    lists = _order_lists(spark, d)
    toks = lists.select("k", list_tokens("txt").alias("toks"))
    voc = multi.vocabulary(toks, "toks", "k")
    return voc.select("token", "first_row", "first_pos", "vocab_idx")


_na_hot_sql = ",\n  ".join(
    f"CAST(coalesce(list_contains(toks, {q(t)}), false) AS INTEGER) AS has_{t}" for t in _LIST_SPARK_TOKENS)


@query("multi_hot_na", f"""{_LIST_SQL}
SELECT k AS l_orderkey,
  {_na_hot_sql},
  CASE WHEN toks IS NULL THEN 1 ELSE 0 END AS has_NA
FROM t""")
def multi_hot_na(spark, d):
    """Multi-hot without a placeholder: a missing list is its own level (has_NA)."""
    lists = _order_lists(spark, d).withColumnRenamed("k", "l_orderkey")
    toks = multi.tokens(lists, "txt")
    return multi.one_hot(toks, "txt", [*_LIST_SPARK_TOKENS, None], prefix="has_")


@query("multi_hot_open", f"""
WITH w AS (SELECT doc_id, unnest({WORDS_SQL.format(c='text')}) AS token FROM documents)
SELECT DISTINCT doc_id, token FROM w WHERE token <> ''""")
def multi_hot_open(spark, d):
    """Multi-hot over an open vocabulary: every word of every document, in
    long form."""
    docs = text_table(spark, d, "documents", "doc_id", "text")
    return multi.long_form(docs.select("doc_id", word_tokens("text").alias("words")), "doc_id", "words")
