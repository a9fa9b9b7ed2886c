"""Spelling variants by a relational trie frontier.

All words, each closed by an end mark, form a trie that is kept as a table of edges
(node, character, label, child): nodes are hashes of prefixes, and chains without a
branch are one edge, so the table has at most two edges per word. A neighbour of a
word leaves its path at a branching node, by one replaced or one inserted character
(a deletion is an insertion seen from the other word), and must from then on follow
edges that spell the rest of the word. States (word, neighbour sought, position,
node), one edit made, are joined with the edge table level by level until no state is
left; those that reach an end are neighbours.

Two words within one edit share their first half or their second half. So there are
two tries, of the words and of the reversed words, and an edit is made in the later
half of either only, where the nodes have few branches: the many states that leave
at the root and die some levels later are never made. Where the edit may be made at
several places of a run of equal characters, the last is taken, at which the two paths
part. Nodes are 64-bit hashes; every neighbour found is compared with the word table by
its full string, so equal hashes can't add one, and they never hide one either.

Only distinct words are moved. Runs are cut and counted by built-in functions with
partial aggregates, so a frequent word costs one row per task.

Defined results: null and empty texts have no words; a null id counts as the empty
string in the hash of a run; rows that are equal count as often as they occur. An
empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import BYTE, ascii_lower, field, mix, nested_row, powers, stored, table

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGED = 31  # one run in so many loses a character
RATIO = 10  # a form is at least so many times as frequent
END = "$"  # no letter, so it cannot occur in a word
FIRST_NODE = LEAST_LENGTH // 2  # no edit is made nearer to a root


# -- Words -----------------------------------------------------------------------

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the distinct words after the damage, with their occurrences."""
    two = nested_row(docs).select(F.coalesce(field(id_col).cast("string"), F.lit("")).alias("id"), field(text_col).cast("string").alias("text"))
    runs = two.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}+"), F.lit(0))).alias("run"))
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(F.pmod(h, F.lit(DAMAGED)) == 0, rest).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


# -- Tries -----------------------------------------------------------------------

def _prefixes(node_bits: int):
    """(reversed, word, at, node, char): every prefix of FIRST_NODE characters and
    more of each word and of each reversed word, and the character after it."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            i = 0
            while i < len(words):
                j, size = i, 0
                while j < len(words) and (j == i or size + len(words[j]) < 1 << 18):
                    size += len(words[j])
                    j += 1
                for backward in (False, True):
                    yield _prefix_rows(words[i:j], backward, node_bits)
                i = j
    return run


def _prefix_rows(words: list[str], backward: bool, node_bits: int) -> pa.RecordBatch:
    # Letters are below U+0100: a byte each. Hashes of all prefixes by running sums.
    data = np.frombuffer("".join((w[::-1] if backward else w) + END for w in words).encode("latin-1"), np.uint8)
    lengths = np.array([len(w) + 1 for w in words])
    first = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(data)) - first[word]
    with np.errstate(over="ignore"):
        terms = BYTE[data] * powers(int(lengths.max()))[at]
        total = np.cumsum(terms, dtype=np.uint64)
        before = total - terms
        node = mix(before - before[first][word] + at.astype(np.uint64) * np.uint64(2) + np.uint64(backward))
    node = (node >> np.uint64(64 - node_bits)).view(np.int64)
    pick = np.flatnonzero(at >= FIRST_NODE)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(pick), backward)), pa.array(words).take(pa.array(word[pick])), pa.array(at[pick].astype(np.int32)),
         pa.array(node[pick]), pa.array(data[pick].astype(np.int16))], ["reversed", "word", "at", "node", "char"])


def _spelled(word, backward):
    """The word in the direction of its trie, with the end mark."""
    return F.concat(F.when(backward, F.reverse(word)).otherwise(word), F.lit(END))


def branch_steps(words: DataFrame, node_bits: int = 64) -> DataFrame:
    """(reversed, word, at, node, char, label, child): the word's edge from each
    branching node on its path to the next one (child null: to its end)."""
    prefixes = words.select("word").mapInArrow(_prefixes(node_bits), "reversed boolean, word string, at int, node bigint, char smallint")
    branching = prefixes.groupBy("node").agg(F.min("char").alias("low"), F.max("char").alias("high")).filter("low < high").select("node")
    steps = prefixes.join(branching, "node")
    path = "(PARTITION BY reversed, word ORDER BY at)"
    steps = steps.withColumn("next", F.expr(f"lead(at) OVER {path}")).withColumn("child", F.expr(f"lead(node) OVER {path}"))
    spelled = _spelled(F.col("word"), F.col("reversed"))
    length = F.coalesce(F.col("next"), F.length(spelled)) - F.col("at")
    return steps.select("reversed", "word", "at", "node", "char", F.substring(spelled, F.col("at") + 1, length).alias("label"), "child")


def edge_table(steps: DataFrame) -> DataFrame:
    """(node, char, label, child, nexts), each edge once: nexts are the characters
    that go on from the child, so a state that cannot go on is never made."""
    edges = stored(steps.select("node", "char", "label", "child").distinct(), "trie_edges")
    nexts = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("nexts"))
    inner = edges.filter("child IS NOT NULL").join(nexts, "child").select("node", "char", "label", "child", "nexts")
    return inner.unionByName(edges.filter("child IS NULL").withColumn("nexts", F.lit(None).cast("string")))


# -- Frontier --------------------------------------------------------------------

def _after(text, at):
    """What follows the first ``at`` characters."""
    return F.substring(text, at + 1, F.length(text))


def _goes_on(spelled, at):
    """Whether the reached node is an end, or an edge goes on from it as the word
    does after ``at`` characters."""
    return F.col("child").isNull() | F.col("nexts").contains(F.substring(spelled, at + 1, F.lit(1)))


def first_edits(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """States after one edit: the word, the neighbour sought (both as the trie spells
    them), how much of it is spelled, and the node reached (null: its end)."""
    half = F.floor(F.length("word") / 2)
    least = F.when(F.col("reversed"), F.length("word") - half).otherwise(half)
    spelled = _spelled(F.col("word"), F.col("reversed"))
    leaving = steps.filter(F.col("at") >= least).select(
        "reversed", "node", F.col("char").alias("own"), F.substring(spelled, F.lit(1), F.col("at")).alias("head"), _after(spelled, F.col("at")).alias("rest"),
        (~(F.col("reversed") & (F.col("at") == least))).alias("inserts"))
    other = edges.filter(F.col("char") != ord(END)).select("node", "char", "label", _after(F.col("label"), F.lit(1)).alias("tail"), "child", "nexts")
    met = leaving.join(other, "node").filter(F.col("char") != F.col("own"))
    tail = F.length("tail")
    # A replaced character: the neighbour with the larger one is found from the other.
    replaced = ((F.col("own") != ord(END)) & (F.col("char") > F.col("own")) & _goes_on(F.col("rest"), tail + 1)
                & (F.substring(F.col("rest"), F.lit(2), tail) == F.col("tail")))
    inserted = F.col("inserts") & _goes_on(F.col("rest"), tail) & F.col("rest").startswith(F.col("tail"))
    made = met.select("*", replaced.alias("replaced"), inserted.alias("inserted")).filter("replaced OR inserted")
    rests = F.array(F.when(F.col("replaced"), _after(F.col("rest"), F.lit(1))), F.when(F.col("inserted"), F.col("rest")))
    made = made.withColumn("then", F.explode(F.array_compact(rests)))
    return made.select("reversed", F.concat("head", "rest").alias("word"), F.concat("head", F.substring("label", 1, 1), "then").alias("near"),
                       (F.length("head") + F.length("label")).alias("at"), F.col("child").alias("node"))


def next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further on; those whose next characters no edge spells die."""
    head = F.ascii(F.substring(F.col("near"), F.col("at") + 1, F.lit(1))).cast("smallint")
    met = states.withColumn("char", head).join(edges, ["node", "char"])
    end = F.col("at") + F.length("label")
    return (met.filter((F.substring(F.col("near"), F.col("at") + 1, F.length("label")) == F.col("label")) & _goes_on(F.col("near"), end))
            .select("reversed", "word", "near", end.alias("at"), F.col("child").alias("node")))


def neighbours(words: DataFrame, node_bits: int = 64) -> DataFrame:
    """(word, near): pairs of words one edit apart, both ways round. ``words`` is a
    stored table of distinct words; ``node_bits`` of a node's hash are used."""
    steps = stored(branch_steps(words, node_bits), "trie_steps")
    edges = stored(edge_table(steps), "trie_edges")
    states = stored(first_edits(steps, edges), "trie_states")
    levels = [states]
    while not (open_ := states.filter("node IS NOT NULL")).isEmpty():
        states = stored(next_level(open_, edges), "trie_states")
        levels.append(states)
    ends = reduce(DataFrame.unionByName, [s.filter("node IS NULL") for s in levels])

    def plain(c):
        word = F.expr(f"substring({c}, 1, length({c}) - 1)")
        return F.when(F.col("reversed"), F.reverse(word)).otherwise(word).alias(c)
    found = ends.select(plain("word"), plain("near"))
    exact = found.join(words.select(F.col("word").alias("near")), "near").select("word", "near")
    return exact.unionByName(exact.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


# -- Groups ----------------------------------------------------------------------

def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Per word: form (its most frequent neighbour, if that is ``ratio`` times as
    frequent), root (the last form reached), n, n_near, form_n. ``words`` is a stored
    table (word, n)."""
    near = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    known = words.join(best, "word", "left").withColumn("near_n", -F.col("top.less"))
    has = F.col("near_n") >= ratio * F.col("n")
    forms = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(has, F.col("top.near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")), "forms")
    # A form is more frequent than its word, so chains end; each turn doubles the steps.
    chain = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = stored(chain.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        chain = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            break
    return forms.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    words = stored(word_counts(table(spark, sf_dir, "documents")), "words")
    return variant_groups(words)


OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM found WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, 2 * octet_length(encode(doc_id || ':' || run)), 2), lambda i: ('0x' || substring(hex(encode(doc_id || ':' || run)), i, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS h
  FROM runs, crc),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (
  SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS d FROM words, unnest(range(1, length(word) + 1)) u(i)),
near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.d = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.d = w.word),
ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS k
  FROM near p JOIN words w ON p.near = w.word),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near, CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form,
         CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.k = 1),
chain AS (
  SELECT word, word AS root, form AS beyond FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.beyond = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.beyond IS NULL
"""
