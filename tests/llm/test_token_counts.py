import random

from tokenizers import Tokenizer

from sparkprep.llm.common import table
from sparkprep.llm.token_counts import TOKEN_LIMIT, TOKENIZER, Counter, count_tokens, op12_token_counts, prove

PARTS = ["a", "B", " ", "\n", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "é", "é", "Σ", "İ", "ß", "1", "²", "½", "ﬁ",
         "你好", "​", "😀", "👩‍👩‍👧", "<|", "\x00", "\xa0", "﻿", "न्", "ᄀ", "ᅡ", "ΟΔΟΣ", "౜", "\U000323b0", "the", "Theaea"]


def library(texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_against_the_library_on_mixed_characters():
    rng = random.Random(12)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(3000)]
    counter = Counter(TOKENIZER, prove(TOKENIZER))
    assert [counter(t) for t in texts] == library(texts)


def test_proof_holds_whole_tokens_only():
    proof = prove(TOKENIZER)
    words = sorted(proof.whole)
    assert len(words) > 30_000
    tokenizer = Tokenizer.from_file(TOKENIZER)
    assert all(len(tokenizer.model.tokenize(tokenizer.pre_tokenizer.pre_tokenize_str(w)[0][0])) == 1 for w in words[::97])


def test_merges_forgotten_when_the_table_is_full(monkeypatch):
    from sparkprep.llm import token_counts
    monkeypatch.setattr(token_counts, "MERGED_BYTES", 60_000)
    counter = Counter(TOKENIZER, prove(TOKENIZER))
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(12)) for _ in range(50)) for _ in range(60)]
    assert [counter(t) for t in texts] == library(texts)
    assert len(counter.lengths) < len(counter.lengths.whole) + 700


def test_query_against_the_library(spark, sf001):
    rows = {r.doc_id: r for r in op12_token_counts(spark, sf001).collect()}
    docs = table(spark, sf001, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d, n in zip(docs, library([d.text for d in docs])):
        r = rows[d.doc_id]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((d.text or "").encode()), n > TOKEN_LIMIT)


def test_nulls_long_texts_and_clashing_columns(spark, docs):
    long = "xyz" * 200_000 + " The end " * 50_000
    rows = [(1, None), (2, ""), (None, "The end"), (4, long), (4, long)]
    got = count_tokens(docs(rows)).collect()
    want = library([t for _, t in rows])
    assert sorted(r.n_tokens for r in got) == sorted(want)
    assert {r.doc_id: (r.n_bytes, r.row, r.n) for r in got}[4] == (len(long), "row", "n")
    named = spark.createDataFrame([("x", 5, "The end")], "text string, n_tokens int, n_bytes string")
    assert count_tokens(named, "n_bytes").columns == ["text", "n_bytes", "n_tokens"]
    assert count_tokens(docs([])).count() == 0
