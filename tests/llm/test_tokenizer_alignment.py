import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from sparkprep.llm import tokenizer_alignment as ta
from sparkprep.llm.common import table

DECODED = ta.LETTER_BYTES


def brute(rows):
    """Results of (key, text) rows, one token and one pair at a time."""
    a = Tokenizer.from_file(ta.FILE_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.FILE_B)
    groups, held = {}, Counter()
    for key, text in rows:
        if not text:
            groups[key] = []
            continue
        want = (" " + text).encode()
        x = [(i, bytes(DECODED[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if b"".join(t for _, t in x) != want or b"".join(t for _, t in y) != want:
            groups[key] = []
            continue
        out, i, j, end_a, end_b, cur = [], 0, 0, 0, 0, ([], [])
        while i < len(x) or j < len(y):
            if end_a <= end_b:
                end_a += len(x[i][1])
                cur[0].append(x[i][0])
                i += 1
            else:
                end_b += len(y[j][1])
                cur[1].append(y[j][0])
                j += 1
            if end_a == end_b:
                out.append(cur)
                cur = ([], [])
        groups[key] = out
        held.update({(p, q) for g in out for p in g[0] for q in g[1]})
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    result = {}
    for key, gs in groups.items():
        links = [(p, q) for g in gs for p in g[0] for q in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in gs)
        result[key] = (sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(links), sum(held[l] == top[l[0]] for l in links),
                       sum(held[l] for l in links), sha256(text.encode()).hexdigest() if gs else "")
    return result


def spark_rows(df, key="id"):
    return {r[key]: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def odd_texts():
    rng = random.Random(13)
    letters = "".join(rng.choice("acgt") for _ in range(3000))
    parts = ["the ", "theaea", "\n", " ", "é", "ê", "你", "😀", "<|endoftext|>", "<s>", "▁", "\x00", "aaaaaaaa", "\t", "123", "ö̈"]
    return [(0, None), (1, ""), (2, " "), (3, "▁"), (4, "a▁b"), (5, letters), (6, "a" * 5000), (7, " " * 999 + "x")] + [
        (k, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for k in range(8, 120)]


def test_merge_path_divides_work_equally():
    rng = np.random.default_rng(1)
    for n_a, n_b, work in [(0, 0, 4), (0, 9, 4), (50, 1, 7), (300, 280, 16), (300, 280, 1), (64, 64, 128)]:
        a, b = (np.sort(rng.choice(2000, n, replace=False)) for n in (n_a, n_b))
        i, j = ta.merge_path(a, b, work)
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        assert (np.diff(i + j)[:-1] == work).all() and i[-1] == n_a and j[-1] == n_b
        for p, q in zip(i, j):
            assert sum(side == 0 for _, side in merged[:p + q]) == p


def test_pieces_give_the_overlaps_of_the_whole():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (np.append(np.sort(rng.choice(np.arange(1, 200), rng.integers(1, 90), replace=False)), 200) for _ in range(2))
        whole = sorted(zip(*(x.tolist() for x in ta.piece_overlaps(a, b, 0, len(a), 0, len(b)))))
        start_a, start_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        assert [w[:2] for w in whole] == [(p, q) for p in range(len(a)) for q in range(len(b)) if max(start_a[p], start_b[q]) < min(a[p], b[q])]
        for work in (1, 2, 3, 10, 1000):
            i, j = ta.merge_path(a, b, work)
            parts = [t for k in range(len(i) - 1) for t in zip(*(x.tolist() for x in ta.piece_overlaps(a, b, i[k], i[k + 1], j[k], j[k + 1])))]
            assert sorted(parts) == whole
            to_a, to_b = ta.stitched_groups(a, b, work)
            common = sorted(set(a.tolist()) & set(b.tolist()))
            assert a[to_a - 1].tolist() == common == b[to_b - 1].tolist()


def test_against_brute_force(spark, docs, monkeypatch):
    rows = odd_texts()
    assert spark_rows(ta.alignment(docs(rows))) == brute(rows)


def test_small_units_and_blocks_give_the_same(monkeypatch):
    a, b = ta.tokens(ta.FILE_A), ta.tokens(ta.FILE_B)
    raw = [(t or "").encode() for _, t in odd_texts()]
    block = ta.Block(a, b, raw)

    def links(units):
        return sorted((d, int(pairs[n]), t) for pairs, held, docs, numbers, times in units
                      for d, n, t in zip(docs.tolist(), numbers.tolist(), times.tolist()))
    whole = list(block.units())
    monkeypatch.setattr(ta, "UNIT_LINKS", 500)
    monkeypatch.setattr(ta, "LONG_GROUP", 2)
    monkeypatch.setattr(ta, "WORK", 3)
    units = list(ta.Block(a, b, raw).units())
    assert len(units) > 3 and links(units) == links(whole)
    assert sum(t for *_, t in links(whole)) == block.n_links.sum()


def test_long_group_is_bounded():
    """A run in which the ends rarely meet: far more links than memory."""
    rng = random.Random(4)
    a, b = ta.tokens(ta.FILE_A), ta.tokens(ta.FILE_B)
    block = ta.Block(a, b, ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)).encode()])
    got = sum(int(times.sum()) for *_, times in block.units())
    assert got == block.n_links[0]


def test_query_against_brute_force(spark, sf001):
    rows = [(r.doc_id, r.text) for r in table(spark, sf001, "documents").collect()]
    assert spark_rows(ta.op13_tokenizer_alignment(spark, sf001), "doc_id") == brute(rows)


def test_empty_repeated_and_null_ids(spark, docs):
    assert ta.alignment(docs([])).count() == 0
    got = [tuple(r) for r in ta.alignment(docs([(None, "the end"), (7, "the end"), (7, "the end"), (7, None)])).collect()]
    assert len(got) == 4 and len(set(got)) == 3
    assert {r[6] for r in got if r[1]} == {3 * r[4] for r in got if r[1]}


def test_rows_of_pairs_are_small_and_stored_once(spark, docs, monkeypatch):
    import os
    rng = random.Random(21)
    words = [bytes(rng.choices(range(97, 123), k=rng.randrange(2, 9))).decode() for _ in range(30_000)]
    texts = [" ".join(rng.choices(words, k=20_000)) for _ in range(8)]
    raw = [t.encode() for t in texts]
    units = list(ta.Block(ta.tokens(ta.FILE_A), ta.tokens(ta.FILE_B), raw).units())
    assert max(sum(x.nbytes for x in unit) for unit in units) < 4 << 20
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(base))
    assert ta.alignment(docs(list(enumerate(texts[:2])))).count() == 2
    assert sorted(f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before) == ["aligned", "pair_counts"]
