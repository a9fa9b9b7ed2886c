"""Token counts by a whole-token shortcut.

Most pre-tokens of a text are words that the vocabulary holds whole. Which of its
strings the merges really build, and so encode alone as one token, is proved once,
before any text is read, by encoding every one of them (:func:`prove`). That set has
at most as many members as the vocabulary, so it is broadcast. Tasks normalise and
pre-tokenise whole texts, count each member of the set as one token and run the merges
only for the pre-tokens outside it, remembered in a table of bounded size.

Strings of the tokenizer's special tokens inside a text are cut out first, on the text
as given, and count as one token each, which is the library's default. Nothing is
added at either end, nothing is truncated or padded.

Defined results: null and empty texts have no bytes and no tokens. Null ids, repeated
rows and other columns don't matter: :func:`count_tokens` passes all columns on and
replaces those that bear the names it adds.
"""

from __future__ import annotations

import json
import re
import sys
from functools import lru_cache
from typing import NamedTuple

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from sparkprep.llm.common import field, nested_row, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
MERGED_BYTES = 1 << 24  # of the pre-tokens whose merges a task remembers


BLOCK = 256  # code points whose classes are proved together,
PROVED = 0x20000  # up to this one; higher ones are taken as unsure


@lru_cache(1)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def special_pattern(path: str) -> re.Pattern | None:
    """Pattern of the special tokens; None without any. Only those found on the
    text as given, without conditions on their surroundings, are handled."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens with conditions are not supported")
    texts = sorted((t["content"] for t in added), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, texts))) if texts else None


def split_pattern(path: str) -> str | None:
    """The pattern whose matches are the pre-tokens, where the tokenizer splits by
    one and then writes bytes as letters; None for other ways of splitting."""
    with open(path, encoding="utf-8") as f:
        steps = (json.load(f)["pre_tokenizer"] or {}).get("pretokenizers", [])
    if [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        return None
    split, letters = steps
    plain = split["invert"] and split["behavior"] == "Removed" and not letters["use_regex"] and not letters["add_prefix_space"]
    return split["pattern"].get("Regex") if plain else None


def byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level vocabularies write for it: itself where
    it is printable, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = byte_letters()
LETTER_BYTES = {c: b for b, c in BYTE_LETTERS.items()}


class Proof(NamedTuple):
    """What is proved of a tokenizer before any text is read."""

    whole: frozenset[str]  # pre-tokens that encode alone as one token
    unsure: str | None  # class of characters that the two regex libraries may take differently


def prove(path: str) -> Proof:
    """Encode every string of the vocabulary and keep those that the merges build
    whole; and find the characters that both regex libraries split alike."""
    tokenizer, pattern = _tokenizer(path), split_pattern(path)
    model = tokenizer.model
    suffix = model.end_of_word_suffix or ""
    letters = (w.removesuffix(suffix) for w in tokenizer.get_vocab(with_added_tokens=False) if w.endswith(suffix))
    letters = [w for w in letters if w and len(model.tokenize(w)) == 1]
    if pattern is None:
        return Proof(frozenset(letters), None)
    whole = set()
    for w in letters:
        try:
            whole.add(bytes(LETTER_BYTES[c] for c in w).decode())
        except UnicodeDecodeError:  # part of a character, never a pre-token
            pass
    return Proof(frozenset(whole), unsure_characters(pattern, pre_tokenizers.Split(Regex(pattern), "removed", invert=True)))


def unsure_characters(pattern: str, splitter) -> str:
    """Class of the characters on which Python's regex library is not proved to split
    as the tokenizer's: each is put between letters, digits and signs, which shows
    whether both take it as a letter, a digit, a space or a sign; no pattern here asks
    for more."""
    fast = regex.compile(pattern)
    unsure = [f"\\U{PROVED:08x}-\\U{sys.maxunicode:08x}"]
    for first in range(0, PROVED, BLOCK):
        block = "".join(f" a{chr(c)}a 1{chr(c)}1 !{chr(c)}!" for c in range(first, first + BLOCK) if not 0xD800 <= c < 0xE000)
        if [span for _, span in splitter.pre_tokenize_str(block)] != [m.span() for m in fast.finditer(block)]:
            unsure.append(f"\\U{first:08x}-\\U{first + BLOCK - 1:08x}")
    return f"[{''.join(unsure)}]"


class _Lengths(dict):
    """Pre-token -> number of tokens, merged where it is not known."""

    def __init__(self, model, whole, as_letters):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.whole, self.as_letters, self.room = model, whole, as_letters, MERGED_BYTES

    def __missing__(self, word: str) -> int:
        letters = word.encode().decode("latin-1").translate(BYTE_LETTERS) if self.as_letters else word
        n = len(self.model.tokenize(letters))
        size = 100 + 2 * len(word)
        if size < MERGED_BYTES >> 8:
            self.room -= size
            if self.room < 0:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
                self.room = MERGED_BYTES
            self[word] = n
        return n


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, path: str, proof: Proof):
        self.tokenizer = _tokenizer(path)
        self.special = special_pattern(path)
        pattern = split_pattern(path)
        self.fast = regex.compile(pattern).findall if pattern else None
        self.unsure = re.compile(proof.unsure) if proof.unsure else None
        self.lengths = _Lengths(self.tokenizer.model, proof.whole, self.fast is not None)
        # The tokenizer's own splitting, before it writes bytes as letters.
        self.exact = pre_tokenizers.Split(Regex(pattern), "removed", invert=True) if pattern else self.tokenizer.pre_tokenizer

    def pretokens(self, text: str) -> list[str]:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        if self.fast is not None and not (self.unsure and self.unsure.search(text)):
            return self.fast(text)
        return [w for w, _ in self.exact.pre_tokenize_str(text)]

    def __call__(self, text: str) -> int:
        parts, n = [text], 0
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            n = len(parts) - 1
        for part in filter(None, parts):
            n += sum(map(self.lengths.__getitem__, self.pretokens(part)))
        return n


def _count(path: str, proof):
    def run(batches):
        counter = Counter(path, proof.value)
        for batch in batches:
            texts = batch.column(1)
            n_bytes, n_tokens = [], []
            for value in texts:  # one text at a time as Python strings
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                n_tokens.append(counter(text))
            out = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["row", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """All columns of ``docs`` with n_bytes (UTF-8) and n_tokens."""
    proof = docs.sparkSession.sparkContext.broadcast(prove(path))
    rows = nested_row(docs).select("row", field(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = rows.mapInArrow(_count(path, proof), schema)
    others = [field(c).alias(c) for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    return counted.select(*others, "n_bytes", "n_tokens")


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
