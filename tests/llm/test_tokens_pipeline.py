import random
import re
import sys
import tracemalloc

import pyarrow as pa
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

import corpus_pipeline
from sparkprep.llm import quality
from sparkprep.llm.common import table
from sparkprep.llm.sentencepiece_nbest import MARK, MODEL, ONE, Model, Pieces, decode, encode

SF001 = "/root/testdata/sf0.001"
VOCAB = {p: (i + 3, -s) for i, (p, s) in enumerate([(MARK, 2.0), ("a", 3.0), ("b", 3.5), ("c", 4.0), ("ab", 4.0), ("ba", 4.25), ("abc", 6.0), (MARK + "a", 3.0),
                                                    (MARK + "ab", 5.0), ("bc", 5.5), ("cab", 6.5), ("aa", 5.5), ("aaa", 8.0), (MARK + MARK, 3.0)])}


def every_segmentation(p, text):
    """(score, ids) of all segmentations of a text, best first."""
    out = []

    def go(i, score, ids, cuts):
        if i == len(text):
            out.append((-score, len(cuts), tuple(reversed(cuts)), ids))
            return
        single = text[i] in p.pieces
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in p.pieces:
                piece, s = p.pieces[text[i:j]]
                go(j, score + s, (*ids, piece), (*cuts, i))
        if not single:
            go(i + 1, score + p.unknown, (*ids, *p._spelled(text[i])), (*cuts, i))

    go(0, 0, (), ())
    return [(-s, ids) for s, _, _, ids in sorted(out)]


def test_lattice_against_enumeration():
    rng = random.Random(2)
    p = Pieces(VOCAB, list(range(100, 356)))
    texts = ["".join(rng.choice("abc" + MARK + "é") for _ in range(rng.randrange(1, 10))) for _ in range(150)]
    for text in texts:
        want = every_segmentation(p, text)
        assert list(p._segment(text, 5)) == want[:5]
        (best,) = p.best_of([text])
        assert (best.score, best.ids) == want[0] and best.loss == (want[0][0] - want[1][0] if len(want) > 1 else best.loss)
        units = p.units(text)
        assert "".join(units) == text
        (got,) = p.nbest([units], 6)
        assert [round(s * ONE) for s, _ in got] == [s for s, _ in want[:6]]
        assert tuple(got[0][1].tolist()) in {ids for s, ids in want if s == want[0][0]} and len({tuple(i.tolist()) for _, i in got}) == len(got)
        for s, ids in got:
            assert p.decode(ids.tolist()) == text and (round(s * ONE), tuple(ids.tolist())) in set(want)


def test_against_the_library(tmp_path):
    """A unigram model file of the same pieces, written by hand."""
    m = proto.ModelProto()
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=piece, score=0, type=kind)
    for piece, (_, score) in VOCAB.items():
        m.pieces.add(piece=piece, score=score, type=1)
    m.trainer_spec.model_type, m.trainer_spec.unk_id = 1, 0
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", True, False
    path = str(tmp_path / "tiny.model")
    open(path, "wb").write(m.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), Model(path, "model")
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 9))).strip() or "a"
        units = own.pieces.units(own.normalise([text])[0])
        got = own.pieces.nbest([[], units, units], 4)[1]
        score = {i: s for i, s in own.pieces.pieces.values()}
        theirs = [sum(score[i] for i in ids) for ids in library.nbest_encode_as_ids(text, 4)]
        assert [round(s * ONE) for s, _ in got] == sorted(theirs, reverse=True)


def test_long_unit_and_ties():
    p = Pieces({"a": (0, -1.0), "aa": (1, -2.0), "aaa": (2, -3.0)}, None)
    for n in (39, 200, 4000):
        units = p.units("a" * n)
        (s, ids), *rest = p.nbest([units], 3)[0]
        assert s == -n and all(x == s for x, _ in rest) and len(ids) == -(-n // 3)  # equal scores: fewest pieces


def test_very_long_units():
    """Time and memory grow with a unit's length, not with its square."""
    p = Pieces({"a": (0, -1.0), "aa": (1, -2.0), "aaa": (2, -3.0)}, None)
    tracemalloc.start()
    found = p._segment("a" * 12_000, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(found)) == 4 and peak < 30 << 20
    units = p.units("a" * 1_000_000)
    got = p.nbest([units], 3)[0]
    assert len(units) == 1 and [s for s, _ in got] == [-1e6] * 3
    assert [len(i) for _, i in got] == [333_334] * 3 and len({i.tobytes() for _, i in got}) == 3
    p.nbest([["a"]], 3)
    assert units[0] not in p._cache
    rng = random.Random(4)
    p = Pieces(VOCAB, list(range(100, 356)))
    text = "".join(rng.choice("abcé") for _ in range(40_000))
    got = p._segment(text, 5)
    score = {i: s for i, s in p.pieces.values()}
    assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True) and len(set(got)) == 5
    assert all(p.decode(ids) == text and s == sum(score.get(i, 0) for i in ids) + text.count("é") * p.unknown for s, ids in got)


def test_model_round_trip(spark):
    texts = ["", None, "plain words", "  two  spaces ", "über 日本 \x00 \t\n x y 😀", "▁mark", "a" * 5000, "plain words", "퟿ é"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "plain words", "x", "y")], "doc_id long, text string, ids string, row string")
    out = encode(docs)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == ["doc_id", "text", "row", "ids", "nbest", "decoded_equal"] and len(rows) == 10 and all(r.decoded_equal for r in rows.values())
    assert rows[0].ids == rows[1].ids == [] and len(rows[0].nbest) == 1 and rows[2].ids == rows[7].ids == rows[None].ids
    for r in rows.values():
        scores = [x.score for x in r.nbest]
        assert scores == sorted(scores, reverse=True) and len({x.ids_key for x in r.nbest}) == len(scores) and r.nbest[0].n_pieces == len(r.ids)
    back = {r.doc_id: r.decoded for r in decode(out).collect()}
    for i, t in enumerate(texts):
        assert back[i] == (t or "").replace(MARK, " ")
    assert encode(docs.limit(0)).collect() == []


def test_vocabulary_is_read_whole():
    m = Model(MODEL)
    assert len(m.pieces.pieces) + 256 + 3 == m.reader.vocab_size()
    assert m.pieces.decode(m.reader.encode("Some text, é😀\n")) == m.normalise(["Some text, é😀\n"])[0]


# -- pipeline ---------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_pipeline(rows, weights, items):
    import pyarrow as pa
    score = quality.score_texts(pa.array([t for _, t in rows]), weights)
    rows = [r for r, s in zip(rows, score) if s >= 0.3]
    last = {}
    for i, t in rows:
        key = t.translate(LOWER)
        last[key] = max(i, last.get(key, i))
    rows = [(i, t) for i, t in rows if last[t.translate(LOWER)] == i]
    sets = []
    for i, t in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        sets.append((i, {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}))
    root = {i: i for i, _ in sets}
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if 100 * len(s & t) >= 75 * len(s | t) and root[i] != root[j]:
                x, y = sorted((root[i], root[j]))
                root = {k: x if v == y else v for k, v in root.items()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for text in items:
        w = word.findall(text.translate(LOWER))
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    kept = []
    for i, t in rows:
        w = word.findall(t.translate(LOWER))
        if root[i] == i and not any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1)):
            kept.append(i)
    return sorted(kept)


def test_pipeline_against_plain(spark):
    docs = table(spark, SF001, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_filter", "exact_copies", "near_copies", "benchmark_free", "token_ids"]
    weights = quality.fit_quality(docs, table(spark, SF001, "labels"), eligible=quality.trainable)
    want = plain_pipeline([(r.doc_id, r.text) for r in docs.collect()], weights, [r.text for r in table(spark, SF001, "benchmark").collect()])
    out = corpus_pipeline.run(spark, SF001)
    assert sorted(r.doc_id for r in out.collect()) == want and 0 < len(want) < 200
    assert out.filter("NOT decoded_equal").isEmpty()


def test_stages_keep_columns_and_take_empty(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.collect() == []
        if name != "token_ids":
            assert out.columns == docs.columns


def test_every_segmentation_is_returned_and_decoded(spark, monkeypatch):
    """The ids of all n best come out, and each of them gives the text back."""
    from sparkprep.llm import sentencepiece_nbest as sp
    texts = ["the theory of relativity", "naïve Ünïcode 🙂 text\x00", "", None, "a a a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sp.encode(df).collect():
        assert [len(w.ids) for w in r.nbest] == [w.n_pieces for w in r.nbest] and list(r.nbest[0].ids) == list(r.ids)
        assert len({tuple(w.ids) for w in r.nbest}) == len(r.nbest) and r.decoded_equal
        m = sp.model(sp.MODEL, "rank")
        assert {m.decode(w.ids) for w in r.nbest} == {m.decode(r.ids)}
    batch = pa.RecordBatch.from_pydict({"row": pa.array([1]), "text": pa.array(["the theory"])})
    m = sp.model(sp.MODEL, "rank")
    real = m.pieces.nbest

    def wrong(units, n):
        return [[*ways[:-1], (ways[-1][0], ways[-1][1][:-1])] for ways in real(units, n)]
    monkeypatch.setattr(m.pieces, "nbest", wrong)  # a fault in the last segmentation alone shows
    (out,) = sp._encode(sp.MODEL, "rank", 4)(iter([batch]))
    assert out.column("decoded_equal").to_pylist() == [False]


def random_words(rng, count):
    letters = "etaoinsrhldE" + "é,.'7日😀"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 14))) for _ in range(count)]


def test_array_segmentations_against_the_search():
    """Score, ids and loss of every word as the search of one lattice gives them."""
    rng = random.Random(11)
    for p in (Model(MODEL).pieces, Pieces(VOCAB, list(range(100, 356))), Pieces({"a": (0, -1.0), "aa": (1, -2.0), "aaa": (2, -3.0)}, None)):
        units = random_words(rng, 400) + ["".join(rng.choice("abc" + MARK + "é") for _ in range(rng.randrange(1, 41))) for _ in range(200)]
        units = list(dict.fromkeys(units + ["a" * k for k in range(1, 41)]))
        assert p.best_of(units) == [p._segment_one(u) for u in units]
        p.nbest([units], 1)
        found = p.solve(units[::-1])
        assert found.score.tolist() == [p._segment_one(u).score for u in units[::-1]]


def test_units_of_many_texts_at_once():
    rng = random.Random(12)
    for p in (Model(MODEL).pieces, Pieces(VOCAB, None), Pieces({"a": (0, -1.0), "b" + MARK: (1, -1.0)}, None)):
        texts = ["", "a", MARK, "", *("".join(rng.choice(["ab", MARK, ",", "é", "\x00", "日", "😀", ".b", "7"]) for _ in range(rng.randrange(30))) for _ in range(300)), ""]
        got = p.cut(texts)
        assert len(set(got.names)) == len(got.names)
        assert [[got.names[k] for k in got.code[a:b]] for a, b in zip(got.cuts, got.cuts[1:])] == [p.units(t) for t in texts]
        again = p.coded([p.units(t) for t in texts])
        assert again.names == got.names and again.code.tolist() == got.code.tolist() and again.cuts.tolist() == got.cuts.tolist()


def test_words_are_segmented_without_a_call_for_each():
    """Python runs per text and per step of the arrays, not per word."""
    p, calls = Model(MODEL).pieces, [0]
    words = list(dict.fromkeys(MARK + w for w in random_words(random.Random(13), 30_000)))
    texts = [[u for w in words[k:k + 2000] for u in p.units(w)] for k in range(0, len(words), 2000)]

    def count(frame, event, arg):
        calls[0] += event == "call"
    sys.setprofile(count)
    try:
        p.nbest(texts, 4)
    finally:
        sys.setprofile(None)
    assert calls[0] < len(words) / 4


def test_words_come_back_from_the_turn_before():
    """A worker that remembers few words gives the same segmentations."""
    rng = random.Random(14)
    few, many = Model(MODEL, cached_words=40).pieces, Model(MODEL).pieces
    pool = random_words(rng, 120) + ["e" * 300, "ta" * 30]
    for _ in range(12):
        texts = [[w for _ in range(20) for w in few.units(rng.choice(pool))] for _ in range(3)]
        assert [[(s, i.tolist()) for s, i in t] for t in few.nbest(texts, 4)] == [[(s, i.tolist()) for s, i in t] for t in many.nbest(texts, 4)]
        assert not any(len(u) > 256 for u in few._cache)


def test_kept_columns(spark):
    docs = spark.createDataFrame([(1, "the theory", "x", 7), (None, None, None, None)], "doc_id long, text string, ids string, `a.b` int")
    whole = encode(docs)
    assert whole.columns == ["doc_id", "text", "a.b", "ids", "nbest", "decoded_equal"]
    for kept in (["doc_id"], ["a.b", "doc_id"]):
        out = encode(docs, kept=kept)
        assert out.columns == [*kept, "ids", "nbest", "decoded_equal"]
        want = whole.select(*[f"`{c}`" for c in out.columns])
        assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
