import base64
import hashlib
import html
import math
import re
import uuid

import pyarrow.parquet as pq

from sparkprep.llm import site_style as S
from sparkprep.llm import warc as W

SF01 = "/root/testdata/sf0.01"


# -- html -----------------------------------------------------------------------------

def plain_article(source):
    """Blocks between article tags, for pages whose blocks are h1 and p."""
    a = source.index("<article>") + 9
    b = min(x for x in (source.find("</article>", a), source.find("<footer", a), len(source)) if x >= 0)
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", source[a:b]))
    return "\n\n".join(x for x in (" ".join(html.unescape(y).split()) for y in blocks) if x)


def test_all_pages_against_plain(spark):
    rows = S.op1_html_extraction(spark, SF01).collect()
    source = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF01}/pages.parquet").to_pylist()}
    assert len(rows) == len(source)
    for r in rows:
        assert r.text == plain_article(source[r.page_id]) and r.n_chars == len(r.text)


def test_markup():
    text = lambda s: S.main_text(S.parse(s))
    assert text("") == "" and text("<p>a") == "a" and text("plain &lt;x&gt;") == "plain <x>"
    assert text("<header>top</header><p>a<b>b</b>\n c&nbsp;<br>d</p><P>e") == "ab c d\n\ne"
    assert text("<div>x<article><header><h1>t</h1></header><p>y<p>z<li>1<li>2</article>w</div>") == "t\n\ny\n\nz\n\n1\n\n2"
    assert text("<article>a<nav>n</nav>b<aside>s</aside><form>f<input></form><div class='cookie-notice'>c</div>"
                "<script>if (a<b) '</p>'</script><section id=comments><p>c</p></section><p>d</article><footer>f") == "a\n\nb\n\nd"
    assert text("<article><p title='a>b'>x<!-- <p>no --> y</p><p hidden>h</p><table><tr><td>1<td>2</table>") == "x y\n\n1\n\n2"
    assert text("<article><p>cut &am") == "cut &am" and text("<article>x<scr") == "x" and text("<article><style>p{}") == ""
    assert text("<div>" * 3000 + "deep") == "deep"


def test_legal_markup_loses_nothing():
    text = lambda s: S.main_text(S.parse(s))
    assert text("<html><head><title>t</title><meta charset=x><body><p>a</p></body></html>") == "a"
    assert text("<head><title>t</title><style>p{}</style> <article><p>a</article>") == "a" and text("<head><link href=x>a<p>b") == "a\n\nb"
    assert text("<html><head><title>t</title></head>\n<body>a") == "a"
    assert text("<article><p>a<svg width='1' />b<p>c <math/>d<svg><path/></svg></article>") == "a\n\nb\n\nc d"
    assert text("<p>a</p><svg><style/><g><path d=x></g><text>no</text></svg><p>b<svg><g><p>c</p><p>d") == "a\n\nb\n\nc\n\nd"
    assert text("<div>x<svg><foreignObject><p>no</p></foreignObject><title>no</title></svg>y</div>") == "x\n\ny"
    assert text("<article><p>If <math display=block><semantics><mrow><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup></mrow>"
                "<annotation encoding='application/x-tex'>a=b^2</annotation></semantics></math> then</p><p>z</article>") == "If a=b2 then\n\nz"


def test_class_words():
    text = lambda s: S.main_text(S.parse(s))
    for tag in ("body class='single no-sidebar'", "div class='content with-sidebar'", "article class='post has-comments'", "main id='ad-free'", "body class='menu'",
                "html id=widget", "article class='promo'", "div role=main class='modal'"):
        assert text(f"<{tag}><p>all of it</p></{tag.split()[0]}>") == "all of it", tag
    assert text("<div>out<div class='overlay'><main><p>x</p></main></div></div>") == "x"
    assert text("<div class='post'>x</div><div class='comments'>no<nav>n</nav></div><div class='menu-with-icons'>m</div>") == "x"
    assert text("<div class='post'>x</div><div class='sidebar'><article>y</article></div>") == "x\n\ny"
    tree = S.parse("<div class='post'>x</div><div class='sidebar'><article>y</article></div>")
    assert S.main_text(tree) == S.main_text(tree)  # reading a tree again gives the same


def test_named_blocks_go_on_hosts_of_every_size(spark):
    """Comments, adverts, sidebars and notices that differ on every page."""
    inside = "<div class='comments'><article>Reader {k} says hello {i}</article></div><div class='ad'>Buy item {i} today</div><p id=cookie-notice>We {i}</p>"
    rows, want = [], {}
    for n in (1, 2, 3, 20):
        for i in range(n):
            k = 100 * n + i
            rows.append((k, f"http://marked{n}.com/{i}", f"<nav>n</nav><article><p>Own text {k}</p>{inside.format(i=i, k=k)}<p>End {k}</p></article>"))
            rows.append((10_000 + k, f"http://plain{n}.com/{i}", f"<div class='post'><p>Own text {k}</p></div><div class='comments'>Reader {k}</div><div id='sidebar'>Links {k}</div>"))
            want |= {k: f"Own text {k}\n\nEnd {k}", 10_000 + k: f"Own text {k}"}
    got = {r.id: r.text for r in S.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_content_outweighs_doubtful_class_words(spark):
    rows = [(i, f"http://w.com/{i}", f"<p>Own {i}</p><div class=widget-text><p>Part {i}</p></div><div class=share-box><p>We use them</p></div>") for i in range(20)]
    rows += [(50, None, rows[0][2])]
    got = {r.id: r.text for r in S.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Own {i}\n\nPart {i}" for i in range(20)) and got[50] == "Own 0"


def page(i, extra=""):
    return f"<body><div class=top>Same words {extra}</div><div class=box><p>Own text of page {i} <i>x</i></p><p>More {i * 7}</p></div><div class=end><span>Always the same</span></div></body>"


def test_style_tree_cuts_repeated_branches(spark):
    rows = [(i, f"http://Site.com/{i}", page(i), "x") for i in range(20)]
    rows += [(100 + i, "http://copy.com/", page(1), "x") for i in range(30)]  # copies of one page count once
    rows += [(200, "http://few.com/", page(5), "x"), (201, None, page(6), "x"), (None, "http://site.com/n", page(7), "x"), (202, "http://site.com/e", None, "x"), (203, "http://site.com/f", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.id, r.url): r.text for r in S.extract_text(pages).collect()}
    own = lambda i: f"Own text of page {i} x\n\nMore {i * 7}"
    whole = lambda i: f"Same words\n\n{own(i)}\n\nAlways the same"
    for i in range(20):
        assert got[i, f"http://Site.com/{i}"] == own(i)
    assert got[None, "http://site.com/n"] == own(7) and got[202, "http://site.com/e"] == got[203, "http://site.com/f"] == ""
    assert got[105, "http://copy.com/"] == whole(1) and got[200, "http://few.com/"] == whole(5) and got[201, None] == whole(6)
    assert S.extract_text(pages.limit(0)).collect() == []


def test_marked_content_is_never_cut(spark):
    """Mirrors: one article, or three, under navigation that differs by page."""
    def mirror(i, words, tag="article"):
        return f"<body><div class=top>{i} other way {i * 3}</div><{tag}><p>{words} one</p><p>{words} two</p></{tag.split()[0]}><div>end {i}</div></body>"

    rows = [(i, f"http://one.com/?s={i}", mirror(i, "same")) for i in range(40)]
    rows += [(100 + i, f"http://three.com/?s={i}", mirror(i, f"text {i % 3}")) for i in range(90)]
    rows += [(200 + i, f"http://role.com/?s={i}", mirror(i, "same", "div role=main")) for i in range(20)]
    rows += [(300 + i, f"http://mixed.com/?s={i}", f"<body><p>always this</p><i>{i}</i></body>") for i in range(20)]
    rows += [(400, "http://mixed.com/", "<body><article><p>always this</p></article></body>")]
    got = {r.id: r.text for r in S.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert got[i] == "same one\n\nsame two"
    for i in range(90):
        assert got[100 + i] == f"text {i % 3} one\n\ntext {i % 3} two"
    assert all(got[200 + i] == "same one\n\nsame two" for i in range(20))
    assert got[400] == "always this"
    tree = S.parse("<body><div><article><p>a</p></article></div></body>")
    assert S.main_text(tree, frozenset([">body", ">body>div", ">body>div>article"])) == "a"


def test_one_rule_at_every_size(spark):
    """Repeated blocks go on small hosts as on large ones; own texts never do."""
    rows = [(100 * n + i, f"http://h{n}.com/{i}", page(i)) for n in (1, 2, 3, 5, 15, 16, 40) for i in range(n)]
    got = {r.id: r.text for r in S.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in (1, 2, 3, 5, 15, 16, 40):
        for i in range(n):
            own = f"Own text of page {i} x\n\nMore {i * 7}"
            assert got[100 * n + i] == (own if n > 2 else f"Same words\n\n{own}\n\nAlways the same")
    score = [S.importance([(">div", 0.0, 0.0)], pages={">div": m})[">div"][1] for m in range(2, 30)]
    assert score == sorted(score, reverse=True) and score[0] == 0.25 and S.importance([(">main", 0.0, 0.0)], pages={">main": 99})[">main"] == (1.0, 1.0)


def test_importance_against_entropies(spark):
    """Presentation and content importances of a small site, by hand."""
    shown = ["<div class=a><p>t1</p></div>"] * 2 + ["<div class=a><p>t1</p><section>u</section></div>"] + ["<div class=a><p>t2</p></div>"]
    rows = [("h", f"{s}<p>{i}</p>") for i, s in enumerate(shown)]
    pages = spark.createDataFrame(rows, "host string, html string")
    seen = {}
    fit = S._cuts
    try:
        S._cuts = lambda t, g: (lambda group: seen.update({p: (a, b) for p, a, b in zip(*(group.column(c).to_pylist() for c in ("path", "shown", "text")))}) or fit(t, g)(group))
        per = S.style_cuts(pages, min_pages=2)
        per.collect()
    finally:
        S._cuts = fit
    cuts = {r.site: r.cut for r in S.style_cuts(pages, threshold=0.7, min_pages=2).collect()}
    assert ">div.a" in cuts["h"] and ">p" not in cuts["h"]  # texts of >p differ on every page
    p, q = 3 / 4, 1 / 4
    entropy = -(p * math.log(p) + q * math.log(q)) / math.log(4)
    content = 1 - (math.log(3) + math.log(1)) / 2 / math.log(4)
    value = S.importance([(">div.a", entropy, None), (">div.a>p", 0.0, content)], gamma=0.9)
    assert abs(value[">div.a"][0] - (0.1 * entropy + 0.9 * 0.9 * content)) < 1e-12


# -- warc -----------------------------------------------------------------------------

def test_round_trip(spark, tmp_path):
    odd = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    rows = [(5, "http://a.b/x y", "é<p>", "c"), (3, None, "é<p>", "c"), (4, "http://a.b/", None, "c"), (6, "u", "", "c"), (7, "http://c/", odd, "c"), (8, "\r\nevil: 1", odd, "c"),
            (9, "big", "z" * 200_000 + "\r\n\r\n", "c"), (11, "f", "x\r\n", "c"), (12, "g", "\r\n\r\r\n\r\n\r", "c"), (None, "n", "é<p>", "c"), (10, "e", "\r\n\r\n", "c"), (5, "http://a.b/x y", "é<p>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type string")
    path = str(tmp_path / "w")
    W.write_warc(pages, path)
    records = W.read_warc(spark, path)
    assert records.count() == 3 * len(rows)
    got = []
    for r in W.assemble(records).collect():
        known = r.metadata.fields
        got.append((known.get("id"), known.get("refers-to-id"), r.response.type, r.response.payload_digest, int(known["payload-bytes"])))
        if r.response.type == "response":
            payload = bytes(r.response.payload)
            assert len(payload) == r.response.payload_bytes == got[-1][4] and W.sha1_base32(payload) == r.response.payload_digest
            assert r.request.concurrent_to == [r.response.record_id]
    want = []
    for i, _, h, _ in rows:
        data = (h or "").encode()
        first = min(j for j, _, g, _ in rows if (g or "") == (h or "") and j is not None)
        again = i is not None and i != first
        want.append((None if i is None else str(i), str(first) if again else None, "revisit" if again else "response",
                     base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_min_bytes_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")], "page_id long, url string, html string")
    W.write_warc(pages, str(tmp_path / "a"), min_bytes=3)
    rows = W.assemble(W.read_warc(spark, str(tmp_path / "a"), with_payload=False)).collect()
    assert sorted((r.metadata.fields["id"], r.response.type) for r in rows) == [("1", "response"), ("2", "response"), ("3", "response"), ("4", "revisit")]
    W.write_warc(pages.limit(0), str(tmp_path / "b"))
    assert W.assemble(W.read_warc(spark, str(tmp_path / "b"))).collect() == []


def record(kind, rid, concurrent, block="", kind_type="text/plain"):
    links = "".join(f"WARC-Concurrent-To: {c}\r\n" for c in concurrent)
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n{links}Content-Type: {kind_type}\r\nContent-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"


def test_links_in_any_direction_and_cut_records(spark, tmp_path):
    a, b, c, d, e, f = (f"<urn:uuid:{uuid.UUID(int=i)}>" for i in range(6))
    text = (record("warcinfo", f, [], "software: x") + record("request", a, []) + record("response", b, [a], "HTTP/1.1 200 OK\r\n\r\nbody", "application/http")
            + record("metadata", c, [a], "k: v\r\n", "application/warc-fields") + record("response", d, [], "HTTP/1.1 200 OK\r\n\r\n", "application/http"))
    (tmp_path / "1.warc").write_bytes((text + record("response", e, [], "cut" * 10)[:-20]).encode())
    (tmp_path / "2.warc").write_bytes(record("metadata", e, [d], "k: w\r\n", "application/warc-fields").encode())
    rows = {r.capture_id: r for r in W.assemble(W.read_warc(spark, str(tmp_path))).collect()}
    assert set(rows) == {b, d}
    assert rows[b].request.rid == a and rows[b].metadata.fields == {"k": "v"} and bytes(rows[b].response.payload) == b"body"
    assert rows[d].request is None and rows[d].metadata.fields == {"k": "w"}


def test_plain_archives_are_not_split(spark, tmp_path):
    """Plain files far longer than a split, with header-like text in blocks."""
    ids = [f"<urn:uuid:{uuid.UUID(int=i)}>" for i in range(400)]
    fake = "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for name, part in (("a", ids[:300]), ("b", ids[300:])):
        (tmp_path / f"{name}.warc").write_bytes("".join(record("resource", r, [], f"{i} " + fake * (i % 9)) for i, r in enumerate(part)).encode())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "1000")
        records = W.read_warc(spark, str(tmp_path))
        got = {r.record_id: bytes(r.payload).decode() for r in records.collect()}
        assert records.sparkSession is spark and spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {r: f"{i % 300} " + fake * (i % 300 % 9) for i, r in enumerate(ids)}
