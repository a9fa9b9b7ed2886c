import random
import re
import zlib
from collections import Counter, defaultdict

from sparkprep.llm import spelling_variants as sv
from sparkprep.llm.common import stored


def brute_words(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().lower().decode()
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_near(words):
    alphabet = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[j:] for i in range(len(w) + 1) for c in alphabet for j in (i, i + 1)}
        near[w] = sorted((edits - {w}) & set(words))
    return near


def brute_groups(words):
    near, form = brute_near(words), {}
    for w, k in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * k else None
    out = {}
    for w, k in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, k, len(near[w]), words[form[w]] if form[w] else None)
    return out


def groups(spark, words):
    table = stored(spark.createDataFrame(list(words.items()) or [], "word string, n bigint"), "words")
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sv.variant_groups(table).collect()}


def test_groups_against_brute_force(spark):
    rng = random.Random(11)
    words = {}
    for letters, length in (("ab", 7), ("ab", 9), ("aé", 8), ("abcxyzÿ×", 7)):
        for _ in range(160):
            w = "".join(rng.choice(letters) for _ in range(rng.randrange(length, length + 3)))
            words[w] = rng.choice([2, 2, 3, 25, 300, 4000])
    words |= {"a" * k: 10 ** (k % 5) * 2 for k in range(7, 17)} | {"a" * 20 + "b" + "a" * 19: 2, "ab" * 50: 2, "ab" * 50 + "b": 50, "ba" * 50: 7}
    assert groups(spark, words) == brute_groups(words)


def test_equal_node_hashes_change_nothing(spark):
    """Most nodes share their hash with others: no pair is lost or added."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(7, 9))): rng.choice([2, 40]) for _ in range(60)}
    table = stored(spark.createDataFrame([(w,) for w in words], "word string"), "words")
    for bits in (1, 3, 64):
        got = defaultdict(list)
        for r in sv.neighbours(table, bits).collect():
            got[r.word].append(r.near)
        assert {w: sorted(got[w]) for w in words} == brute_near(words)


def test_words_against_brute_force(spark, docs):
    rng = random.Random(2)
    parts = ["Theaeaths", "éLÉVEÀÿs", "straße×straße", "abcdefg", "abcdefgh", "don't", "x1yz", "Ωmegaaaaaaa", "a" * 3000, "\n", " ", ". "]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(30))) for k in range(300)]
    rows += [(None, "Theaeaths nullident"), (None, "Theaeaths nullident"), (5, None), (6, ""), (7, "abcdefg " * 500), (7, "abcdefg " * 500)]
    got = {r.word: r.n for r in sv.word_counts(docs(rows)).collect()}
    assert got == brute_words(rows)
    assert any(len(w) == 2999 for w in got)


def test_query_against_brute_force(spark, sf001):
    rows = [(r.doc_id, r.text) for r in sv.table(spark, sf001, "documents").collect()]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sv.op11_spelling_variants(spark, sf001).collect()}
    assert got == brute_groups(brute_words(rows))


def test_empty_tables_and_one_word(spark, docs):
    assert sv.word_counts(docs([])).count() == 0
    assert groups(spark, {}) == {}
    assert groups(spark, {"abcdefg": 3}) == {"abcdefg": (None, "abcdefg", 3, 0, None)}


def test_chains_lead_to_the_last_form(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "abcdefghijkl": 200000}
    got = groups(spark, words)
    assert {w: g[1] for w, g in got.items()} == dict.fromkeys(words, "abcdefghijkl")
    assert defaultdict(int, Counter(g[3] for g in got.values())) == {1: 2, 2: 4}
