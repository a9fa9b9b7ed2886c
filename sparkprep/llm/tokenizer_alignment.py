"""Alignment of two tokenizers' tokens, and corpus-wide link counts.

Both tokenizers cut the same bytes. Where tokens of A and of B end at one byte offset
they cut the text into groups; every A token of a group is linked with every B token
of it. The ends of both are merged along the merge path: diagonal binary searches
(:func:`merge_path`) divide the merge into pieces of equal work, none of which needs
another. A piece (:func:`piece_overlaps`) gives the pairs of tokens that overlap in
it and marks those that end together; :func:`stitched_groups` joins the run left open
at a piece's border with the next piece's.

Tasks work on blocks of whole texts and write, for each block, one row per text and
the linked id pairs in units of bounded size: the distinct pairs, how many texts of
the block hold each, and the pair numbers and multiplicities of every text. Pairs are
counted over the corpus by an ordinary aggregate of (pair, texts); the counts go back
to the units that hold the pair, not to texts, so what is moved grows with the blocks'
distinct pairs and not with the tokens.

Long groups (a run in which the tokenizers never agree) are first reduced to distinct
ids with multiplicities, and a block's pairs are made for a range of A ids at a time,
so neither the number of occurrences nor their product has to fit in memory.

Defined results: texts that are null, empty, or whose joined token bytes differ from
the text have no tokens: counts 0 and an empty digest. Null ids and repeated rows are
rows of their own. Other columns are never read.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from sparkprep.llm.common import field, nested_row, release, releasing, stored, table, text_chunks
from sparkprep.llm.token_counts import BYTE_LETTERS, LETTER_BYTES, unsure_characters

FILE_A = public_tokenizers.path("byte_bpe_50k.json")
FILE_B = public_tokenizers.path("piece_bpe_32k.model")
BLOCK_BYTES = 1 << 20  # of texts aligned together
ENCODED_BYTES = 1 << 19  # encoded at a time
MERGED_BYTES = 16 << 20  # of the words whose ids a worker remembers
WORK = 1 << 16  # steps of a merge piece
LONG_GROUP = 64  # links from which a group is reduced to distinct ids
UNIT_LINKS = 1 << 16  # made at a time, and in one row
ROW_GROUP_BYTES = 16 << 20  # of the stored blocks: their writers and readers hold a row group
MARK = "▁"


# -- Merge path ------------------------------------------------------------------

def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted arrays (of equal values, a's first) stands after
    each multiple of ``work`` steps: how many of a and of b it has taken. One binary
    search along each diagonal, all diagonals at once."""
    diagonal = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = np.zeros(len(diagonal), bool)
        taken[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low = np.where(open_ & taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low, diagonal - low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i: int, i_to: int, j: int, j_to: int):
    """Overlapping token pairs whose overlap ends within one piece of the merge: those
    that end with a's token, in order, and then those that b's alone ends.

    Returns (index in a, index in b, whether both end there). An end of both at the
    border, a's in this piece and b's in the next, is told by b's value alone."""
    ours, theirs = a[i:i_to], b[j:j_to]
    at_a = np.searchsorted(theirs, ours, "left")  # b tokens of the piece that end before
    at_b = np.searchsorted(ours, theirs, "left")
    same = np.zeros(len(ours), bool)
    inside = at_a < len(theirs)
    same[inside] = theirs[at_a[inside]] == ours[inside]
    if len(ours) and not inside[-1] and j_to < len(b):
        same[~inside] = b[j_to] == ours[~inside]
    common = np.zeros(len(theirs), bool)
    inside_b = at_b < len(ours)
    common[inside_b] = ours[at_b[inside_b]] == theirs[inside_b]
    if i > 0:
        common |= theirs == a[i - 1]
    alone = ~common  # b's that end by themselves; the others come with their a
    left = np.concatenate([np.arange(i, i_to), i + at_b[alone]])
    right = np.concatenate([j + at_a, np.arange(j, j_to)[alone]])
    both = np.concatenate([same, np.zeros(int(alone.sum()), bool)])
    return left, right, both


def stitched_groups(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the groups of two token sequences over the same bytes: for each group
    the number of a tokens and of b tokens up to its last ones. A group goes on
    through pieces until one marks a pair that ends together."""
    i, j = merge_path(a, b, work)
    ends = []
    for k in range(len(i) - 1):
        left, right, both = piece_overlaps(a, b, i[k], i[k + 1], j[k], j[k + 1])
        ends.append((left[both] + 1, right[both] + 1))
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([e for e, _ in ends]), np.concatenate([e for _, e in ends])


# -- Tokenizers ------------------------------------------------------------------

class _Merged(dict):
    """Pre-token -> its ids, merged where they are not known."""

    def __init__(self, model):
        super().__init__()
        self.model, self.room = model, MERGED_BYTES

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_LETTERS))])
        size = 250 + 10 * len(word)
        if size < MERGED_BYTES >> 8:
            self.room -= size
            if self.room < 0:
                self.clear()
                self.room = MERGED_BYTES
            self[word] = ids
        return ids


class Tokens:
    """Encodes texts to ids; ``bytes`` holds the bytes that each id stands for.

    ``.json`` files are byte-level vocabularies and get a space before the text,
    ``.model`` files add it themselves. Words of a byte-level vocabulary are merged
    once and remembered in a table of bounded size; texts with characters that Python's
    regex library may split otherwise go through the tokenizer as a whole."""

    def __init__(self, path: str, unsure: str | None = None):
        self.adds_space = path.endswith(".model")
        if self.adds_space:
            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.bytes = [self._piece(i) for i in range(self.model.get_piece_size())]
        else:
            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = True
            size = self.model.get_vocab_size(with_added_tokens=True)
            letters = [self.model.id_to_token(i) or "" for i in range(size)]
            self.bytes = [bytes(LETTER_BYTES[c] for c in w) if all(c in LETTER_BYTES for c in w) else w.encode() for w in letters]
            self.unsure = re.compile(unsure) if unsure else None
            self.split = regex.compile(public_tokenizers.PATTERN).findall
            self.merged = _Merged(self.model.model)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def _piece(self, i: int) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:-1], 16)])
        return self.model.id_to_piece(i).replace(MARK, " ").encode()

    def __call__(self, texts: list[str]) -> list[list[int]]:
        if self.adds_space:
            return self.model.encode(texts, num_threads=1)
        return [self._ids(" " + t) for t in texts]

    def _ids(self, text: str) -> list[int]:
        if self.unsure is None or self.unsure.search(text):
            return self.model.encode(text, add_special_tokens=False).ids
        return list(chain.from_iterable(map(self.merged.__getitem__, self.split(text))))


def unsure_of(path: str) -> str | None:
    """Characters of texts that must go through the tokenizer as a whole; None for
    all, where the tokenizer has other steps than the usual byte-level split."""
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)
    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if steps["normalizer"] is not None or usual.items() - (steps["pre_tokenizer"] or {}).items():
        return None
    return unsure_characters(public_tokenizers.PATTERN, pre_tokenizers.ByteLevel(add_prefix_space=False))


@lru_cache(2)
def tokens(path: str, unsure: str | None = None) -> Tokens:
    return Tokens(path, unsure)


def encoded(tokenizer: Tokens, raw: list[bytes]) -> list[np.ndarray]:
    """Ids of each text; none where their joined bytes aren't a space and the text."""
    out, part, size = [], [], 0
    for k, text in enumerate(raw):
        part.append(text)
        size += len(text)
        if size >= ENCODED_BYTES or k == len(raw) - 1:
            for text, ids in zip(part, tokenizer([t.decode() for t in part])):
                good = text and b"".join(map(tokenizer.bytes.__getitem__, ids)) == b" " + text
                out.append(np.array(ids if good else [], np.int32))
            part, size = [], 0
    return out


class Block:
    """The aligned tokens of consecutive texts."""

    def __init__(self, a: Tokens, b: Tokens, raw: list[bytes]):
        ids_a, ids_b = encoded(a, raw), encoded(b, raw)
        empty = np.zeros(0, np.int32)
        whole = [len(x) > 0 and len(y) > 0 for x, y in zip(ids_a, ids_b)]
        ids_a, ids_b = ([x if w else empty for x, w in zip(ids, whole)] for ids in (ids_a, ids_b))
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        self.a, self.b = (np.concatenate([empty, *ids]) for ids in (ids_a, ids_b))
        # Texts lie one after another, so their last ends are common ends too.
        self.to_a, self.to_b = stitched_groups(np.cumsum(a.lengths[self.a]), np.cumsum(b.lengths[self.b]))
        self.k_a, self.k_b = np.diff(self.to_a, prepend=0), np.diff(self.to_b, prepend=0)
        self.doc = np.searchsorted(np.cumsum(self.n_a), self.to_a, "left")  # text of each group
        n = len(raw)
        self.n_groups = np.bincount(self.doc, minlength=n)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, self.doc, self.k_a * self.k_b)
        self.vocabulary_b = len(b.bytes)

    def digests(self, a_texts, b_texts) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per text; empty without tokens."""
        groups = np.arange(len(self.to_a))
        of_a, of_b = np.repeat(groups, self.k_a), np.repeat(groups, self.k_b)
        at_a = np.arange(len(self.a)) + (self.to_b - self.k_b)[of_a]
        at_b = np.arange(len(self.b)) + self.to_a[of_b]
        sign_a, sign_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        sign_a[self.to_a - 1] = 1
        sign_b[self.to_b - 1] = 1
        parts = np.empty(len(self.a) + len(self.b), object)
        parts[at_a] = a_texts[self.a * 2 + sign_a]
        parts[at_b] = b_texts[self.b * 2 + sign_b]
        out, begin = [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append(sha256("".join(parts[begin:begin + n].tolist())[:-1].encode()).hexdigest() if n else "")
            begin += n
        return out

    def _occurrences(self, ids, to, k, long):
        """(group, id, times) of the tokens; one entry per id in long groups."""
        group = np.repeat(np.arange(len(to)), k)
        at_long = long[group]
        if not at_long.any():
            return group, ids.astype(np.int64), np.ones(len(ids), np.int64)
        key, times = np.unique(group[at_long].astype(np.int64) << 32 | ids[at_long], return_counts=True)
        group = np.concatenate([group[~at_long], key >> 32])
        ids = np.concatenate([ids[~at_long].astype(np.int64), key & 0xFFFFFFFF])
        times = np.concatenate([np.ones(int((~at_long).sum()), np.int64), times])
        order = np.argsort(group, kind="stable")
        return group[order], ids[order], times[order]

    def units(self):
        """Yield (distinct pairs, texts that hold each; then for every text and pair
        of it the text, the number of the pair and the number of links)."""
        if not len(self.a):
            return
        long = self.k_a * self.k_b > LONG_GROUP
        g_a, id_a, t_a = self._occurrences(self.a, self.to_a, self.k_a, long)
        g_b, id_b, t_b = self._occurrences(self.b, self.to_b, self.k_b, long)
        per_group = np.bincount(g_b, minlength=len(self.to_a))
        first_b = np.cumsum(per_group) - per_group
        links = per_group[g_a]
        # Ranges of A ids with about UNIT_LINKS links each; an id is in one range.
        by_id = np.cumsum(np.bincount(id_a, weights=links, minlength=1)).astype(np.int64)
        of_range = ((by_id - 1) // UNIT_LINKS)[id_a]
        bits_b = int(self.vocabulary_b - 1).bit_length()
        bits = bits_b + int(id_a.max()).bit_length()
        for r in np.unique(of_range):
            mine = np.flatnonzero(of_range == r)
            n = links[mine]
            a = np.repeat(mine, n)
            b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + first_b[g_a[a]]
            key = self.doc[g_a[a]] << bits | id_a[a] << bits_b | id_b[b]
            if long.any():
                times = t_a[a] * t_b[b]
                order = np.argsort(key, kind="stable")
                heads = np.flatnonzero(np.diff(key[order], prepend=-1))
                key, total = key[order][heads], np.add.reduceat(times[order], heads)
            else:
                key, total = np.unique(key, return_counts=True)
            pairs, number = np.unique(key & ((1 << bits) - 1), return_inverse=True)
            yield (pairs >> bits_b) << 32 | pairs & ((1 << bits_b) - 1), np.bincount(number, minlength=len(pairs)), key >> bits, number, total


# -- Spark -----------------------------------------------------------------------

# Rows of texts (at = number in the block) and rows of units (at is null).
_BLOCKS = ("block bigint, at int, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs binary, held binary, docs binary, numbers binary, links binary")


def _align(file_a: str, file_b: str):
    unsure_a, unsure_b = unsure_of(file_a), unsure_of(file_b)

    def run(batches):
        a, b = tokens(file_a, unsure_a), tokens(file_b, unsure_b)
        a_texts = np.array(list(chain.from_iterable((f"{i},", f"{i}|") for i in range(len(a.bytes)))), object)
        b_texts = np.array(list(chain.from_iterable((f"{i},", f"{i};") for i in range(len(b.bytes)))), object)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            id_type = batch.schema.field(0).type
            schema = pa.schema([("block", pa.int64()), ("at", pa.int32()), ("id", id_type)]
                               + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", pa.string())]
                               + [(c, pa.binary()) for c in ("pairs", "held", "docs", "numbers", "links")])

            def rows(n, **columns):
                arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            for i, j, data, at in text_chunks(batch.column(1), BLOCK_BYTES):
                raw = memoryview(np.ascontiguousarray(data))
                block = Block(a, b, [bytes(raw[s:e]) for s, e in zip(at[:-1], at[1:])])
                yield rows(j - i, block=np.full(j - i, number), at=np.arange(j - i), id=batch.column(0).slice(i, j - i), n_a=block.n_a, n_b=block.n_b,
                           n_groups=block.n_groups, n_links=block.n_links, groups_sha256=block.digests(a_texts, b_texts))
                for pairs, held, docs, numbers, links in block.units():
                    yield rows(1, block=[number], pairs=[pairs.tobytes()], held=[held.astype(np.int32).tobytes()], docs=[docs.astype(np.int32).tobytes()],
                               numbers=[numbers.astype(np.int32).tobytes()], links=[links.tobytes()])
                del block
                number += 1
                release()  # a block's arrays, before the next one's
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """Stored table of aligned blocks: a row per text and rows of linked pairs, each
    with a number ``unit``."""
    rows = nested_row(docs).select(field(id_col).alias("id"), field(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    aligned = rows.mapInArrow(releasing(_align(file_a, file_b)), _BLOCKS.format(kind=kind))
    return stored(aligned.withColumn("unit", F.monotonically_increasing_id()), "aligned", ROW_GROUP_BYTES)


def _pair_rows(batches):
    for batch in batches:
        for unit, pairs, held in zip(*(batch.column(c).to_pylist() for c in range(3))):
            pairs, held = np.frombuffer(pairs, np.int64), np.frombuffer(held, np.int32)
            for i in range(0, len(pairs), 1 << 16):
                p, h = pairs[i:i + (1 << 16)], held[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), unit)), pa.array(np.arange(i, i + len(p), dtype=np.int32)), pa.array(p), pa.array(h)],
                                                 ["unit", "number", "pair", "held"])


def _sums(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per text of a unit: links whose count is their A id's highest, and the sum of
    counts over the links."""
    count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
    number = right["number"].to_numpy()
    count[number], best[number] = right["count"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
    (unit,) = left.to_pylist()
    docs, numbers = np.frombuffer(unit["docs"], np.int32), np.frombuffer(unit["numbers"], np.int32)
    links = np.frombuffer(unit["links"], np.int64)
    heads = np.flatnonzero(np.diff(docs, prepend=-1))
    return pa.table({"block": pa.array(np.full(len(heads), unit["block"])), "at": pa.array(docs[heads]),
                     "n_best": pa.array(np.add.reduceat(links * best[numbers], heads)),
                     "count_sum": pa.array(np.add.reduceat(links * count[numbers], heads))})


def units_of(aligned: DataFrame) -> DataFrame:
    """The rows of linked pairs, read where they are."""
    return aligned.filter("at IS NULL").select("unit", "block", "pairs", "held", "docs", "numbers", "links")


def pair_rows(units: DataFrame) -> DataFrame:
    """(unit, number, pair, held): the distinct linked pairs of each unit."""
    return units.select("unit", "pairs", "held").mapInArrow(releasing(_pair_rows), "unit bigint, number int, pair bigint, held int")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per linked pair (A id in the upper 32 bits): how many texts hold it, and
    whether that is the most of any pair of its A id."""
    counts = pairs.groupBy("pair").agg(F.sum("held").alias("count"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "pair_counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """One row per text: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = align(docs, id_col, text_col, file_a, file_b)
    units = units_of(aligned)
    pairs = pair_rows(units)
    counted = pairs.select("unit", "number", "pair").join(pair_counts(pairs), "pair").select("unit", "number", "count", "best")
    sums = (units.select("unit", "block", "docs", "numbers", "links").groupBy("unit").cogroup(counted.groupBy("unit"))
            .applyInArrow(_sums, "block bigint, at int, n_best bigint, count_sum bigint"))
    sums = sums.groupBy("block", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    texts = aligned.filter("at IS NOT NULL").select("block", "at", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return texts.join(sums, ["block", "at"], "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")


def op13_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
