import random
import re

import pytest

from sparkprep.llm import phrase_index as P
from sparkprep.llm import url_filter as U

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def plain(rows, items, n=10):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            q = words(text)
            size = min(n, len(q))
            for k in range(len(q) - size + 1 if q else 0):
                for s in range(len(w) - size + 1):
                    if w[s:s + size] == q[k:k + size]:
                        hit.update(range(s, s + size))
                        found.add(item)
        out.append((i, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=str)


def run(spark, docs, rows, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = P.contamination(docs(rows), table).collect()
    return sorted(((r.id, r.n_words, r.n_hit, list(r.item_ids)) for r in got), key=str)


def test_cases(spark, docs):
    ten = "a1 b2 C3 d4 é5 f6 g7 h8 i9 j10"
    items = [(1, ten), (2, "short item"), (2, "k l m n o p q r s t u"), (3, None), (4, ""), (10, ten + " tail"), (None, "lone")]
    rows = [(1, f"x {ten.upper().replace('É', 'é')}! y"), (2, "Short, ITEM? short item"), (3, None), (4, ""), (5, "k-l m n o p q r s t u"),
            (6, "a1 b2 c3 d4 é5 f6 g7 h8 i9"), (None, ten), (7, "lone"), (7, "lone"), (8, "pad " * 20_000 + ten)]
    assert run(spark, docs, rows, items) == plain(rows, items)
    assert run(spark, docs, [], items) == [] and all(r[2] == 0 for r in run(spark, docs, rows, []))


@pytest.mark.parametrize("segment", [50, 1 << 20])
def test_random(spark, docs, monkeypatch, segment):
    monkeypatch.setattr(P, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(P, "BLOCK_WINDOWS", 7)
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    rows, items = [(i, text(rng.randrange(60))) for i in range(40)], [(i, text(rng.randrange(16))) for i in range(8)]
    assert run(spark, docs, rows, items) == plain(rows, items)


def test_proximity(spark, docs):
    index = P.build_index(docs([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha q q q q q beta gamma")]))
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    places = {(r.segment, r.place): r.id for r in P.indexed_docs(index).collect()}
    found = lambda slop: {places[r.segment, r.place] for r in P.search(index, items, slop=slop).collect()}
    assert found(0) == {2} and found(1) == {1, 2} and found(5) == {1, 2, 3}
    with pytest.raises(ValueError):
        P.search(index, items, slop=P.GAP)


def test_drop_contaminated(spark, docs):
    table = docs([(1, "one two three"), (1, "clean"), (None, "one two three"), (None, "clean"), (2, None)])
    out = P.drop_contaminated(table, spark.createDataFrame([(1, "two three")], "item_id long, text string"))
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "clean"), (None, "clean"), (2, None)], key=str)


# -- urls -------------------------------------------------------------------------

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "bare.net")]


def plain_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    best = None
    for verdict, rule in RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best and best[1], best[0] if best else "allow"


URLS = ["http://a.example.org/es/x", "https://EXAMPLE.org/en/12?q#f", "http://example.org/en/2", "http://x.com/de/", "http://xcom/de/", "http://x.com/fr/a#b",
        "http://x.com/fr", "ftp://org", "http://org/", "http://bare.net", "http://sub.bare.net/any?x", "http://notbare.net/", "no scheme", "", None,
        "http://é.org/ü", "http://u@h.com:8/de/1", "a://b://c.org/", "http://.org/", "http://x.org\n/y", "http://" + "a." * 500 + "org/" + "p" * 5000]


def test_urls(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate([*URLS, URLS[0], None])] + [(None, URLS[0], "x", "y")]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = {(r.id, r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(table, RULES).collect()}
    assert got == {(i, *plain_verdict(u)) for i, u, _, _ in rows}
    assert U.judge_urls(table.limit(0), RULES).collect() == []
    assert {r.verdict for r in U.judge_urls(table, [], default="block").collect()} == {"block"}


def test_colliding_keys_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(U, "_keys", lambda strings: __import__("numpy").full(len(strings), 5, "uint64"))
    (tmp_path / "rules").write_bytes(U.pack_rules(RULES))
    rules = U.RuleArray(str(tmp_path / "rules"))
    found = rules.find([b"org/", b"absent/", b"com/de/"])
    assert rules.text(found[0]) == b"org/" and found[1] == -1 and rules.text(found[2]) == b"com/de/"


def test_text_key_is_sparks(spark):
    for t in ("", "é text"):
        assert spark.createDataFrame([(t,)], "t string").selectExpr("xxhash64(t) h").first().h == P.text_key(t.encode())
