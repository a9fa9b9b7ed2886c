"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree of style paths (tags with their
classes, from the root down). For a path on m pages, two importances are taken:

* presentation: the entropy, to base m, of the child sequences with which the
  pages show it. A branch that every page shows in one way scores 0;
* content: 1 minus the mean, over the distinct texts at the path, of
  ``log_m(pages with that text)``. Text that stands on every page scores 0,
  text of a single page 1.

A node's composite importance is ``(1 - gamma) * presentation + gamma * mean
importance of its branches``, the text at the node being one branch. A branch
whose own importance and that of everything below it is under ``threshold`` is
removed from every page of the host. Elements that HTML declares to be
navigation, header, footer, aside, form, script and the like are left out, and so
are those whose class or id names them (comments, adverts, sidebars, notices, menus;
not in no-sidebar, has-comments, with-menu, ad-free): on every host, as their texts
differ from page to page and no entropy can tell them. Words that name content as
often (widget, social, pager) give presentation importance 0: such elements are left
out unless their composite importance, by the content of their branches, reaches
``threshold`` on their host. Class words don't count on html, body, article and main
and on what the marked content lies in. Where a page marks its
content (article, main, role main), what lies outside has 0, and the marked
root has composite importance 1: neither it nor what it lies in is ever cut.

One rule holds at every size: the score that is compared with ``threshold`` is
``(1 - 1 / m**2) * importance + prior / m**2``, where the prior is 0 at and below
elements with such a word and 1 elsewhere. A block repeated on two pages is kept
for want of evidence, on three and more it is not. Pages of one content text count
once, whatever stands around it, and pages without a host and paths on a single
page are judged by the prior alone. The counts are partial aggregates over (path, value) hashes, so a host
with a third of all pages is one partial row a task for each value; only one
row per path reaches the task that walks a host's tree, and only paths on
``min_pages`` pages (two, the least that have an entropy) do.

Defined results: null or empty html gives an empty text. Broken or cut markup
is read as far as it goes; an open head ends at the first text or element that
can't be in it, an open svg at the first html element. Formulas (math) are text
of their block, without their annotations. White space (Unicode) inside a block becomes one
space, ``br`` counts as white space, empty blocks are left out, blocks are
joined by two newlines. Null ids, repeated rows and ties change nothing; other
columns are not read.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.llm.common import ascii_lower, nested_row, stored, table

THRESHOLD = 0.2
GAMMA = 0.9
MIN_PAGES = 2

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object textarea title select".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())  # may stand in a head
FOREIGN = frozenset(["svg", "math"])
# Html in svg and math stays there inside these, and ends them elsewhere.
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mn mo ms mtext".split())
ENDS_FOREIGN = frozenset("article aside b big blockquote body br center code dd div dl dt em embed footer form h1 h2 h3 h4 h5 h6 head header hr i img li "
                         "listing main menu meta nav nobr ol p pre ruby s section small span strike strong sub sup table tt u ul var".split())
MATH = frozenset("math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
                 "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics annotation annotation-xml".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg object textarea title select "
                       "button input dialog menu annotation annotation-xml".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMED_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation "
                        "menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter "
                        "subscribe signup comment comments disqus reply replies".split())
NOISE_WORDS = NAMED_WORDS | frozenset("share sharing social widget toolbar pagination pager login".split())
CONTENT_TAGS = frozenset(["article", "main"])
PLAIN_TAGS = CONTENT_TAGS | {"html", "body"}  # class words don't count on these
# What takes back a word of a class name after it, or before it.
BEFORE = frozenset("no non not has have with without hide".split())
AFTER = frozenset(["free", "less"])
DOUBT = "\x1e"  # ends the names of elements with a class word
# An open element of the second kind is closed by the first.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                     "section table ul".split())
SCOPE = frozenset("html body article main section div table td th ul ol dl blockquote aside header footer nav form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "name", "noise", "doubt", "named", "content", "parts", "parent")

    def __init__(self, tag, name, noise, doubt, content, parent, named=False):
        self.tag, self.name, self.noise, self.doubt, self.content, self.parent, self.parts = tag, name, noise, doubt, content, parent, []
        self.named = named  # by a word that leaves no doubt


def _noise_word(token: str) -> str | None:
    """The word for what isn't content in one class name or id."""
    words = _WORD.findall(token)
    for i, word in enumerate(words):
        if word in BEFORE:
            return None
        if word in NOISE_WORDS and not AFTER.intersection(words[i + 1:i + 2]):
            return word
    return None


def _element(tag: str, attrs: str, parent: Node) -> Node:
    name, noise, said, content = tag, tag in NOISE_TAGS, set(), tag in CONTENT_TAGS
    if attrs and "=" in attrs or " hidden" in attrs:
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                if key == "class":
                    name += "".join("." + c for c in sorted(set(value.split())))
                said.update(filter(None, map(_noise_word, value.split())))
            elif key == "role":
                noise = noise or value in NOISE_ROLES
                if value == "main" and not content:
                    content, name = True, name.replace(tag, "main", 1)
            elif key == "hidden":
                noise = True
    doubt = bool(said) and not content and tag not in PLAIN_TAGS
    return Node(tag, name + DOUBT if doubt else name, noise, doubt, content, parent, bool(said & NAMED_WORDS))


def _foreign(node: Node | None) -> Node | None:
    """The innermost svg or math that a node is or lies in."""
    while node is not None and node.tag not in FOREIGN:
        node = node.parent
    return node


def parse(source: str) -> Node:
    """The page's element tree; parts are text and nodes in page order."""
    root = top = Node("", "", False, False, False, None)
    at, n, foreign = 0, len(source), None  # foreign: the open svg or math
    while at < n:
        m = _TOKEN.search(source, at)
        text = source[at:m.start() if m else n]
        if text:
            if top.tag == "head" and text.strip():
                top = top.parent
            top.parts.append(text)
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            node = top
            while node.parent is not None and node.tag != tag:
                node = node.parent
            if node.parent is not None:
                top = node.parent
                foreign = _foreign(top) if foreign else None
            continue
        if foreign and tag in ENDS_FOREIGN:
            node = top
            while node is not foreign and node.tag not in HOLDS_HTML:
                node = node.parent
            if node is foreign:
                top = foreign.parent
                foreign = _foreign(top)
        if top.tag == "head" and tag not in HEAD:
            top = top.parent
        ends = CLOSES.get(tag) or ({"p"} if tag in CLOSES_P else ())
        if ends:
            node = top
            while node.parent is not None and node.tag not in ends and node.tag not in SCOPE:
                node = node.parent
            if node.tag in ends:
                top = node.parent
                foreign = _foreign(top) if foreign else None
        node = _element(tag, m[3], top)
        top.parts.append(node)
        closed = m[3].endswith("/")
        if tag in RAW and not (foreign and closed):
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else n
        elif tag not in VOID and not closed:
            top = node
            foreign = node if tag in FOREIGN else foreign
    return root


def _is_noise(node: Node, in_content: bool) -> bool:
    return node.noise or (node.tag == "header" and not in_content)


def _marked(root: Node) -> set[int]:
    """Ids of the nodes by which the page marks its content, somewhere that
    isn't noise, and of all nodes around them. Class words of these nodes are
    taken back. An article inside an element with a class word (a comment, a
    teaser) marks nothing; where nothing is marked, it is kept like other blocks."""
    found, others, stack = set(), [], [(root, False)]

    def take_back(node, done):
        while node is not None and id(node) not in done:
            done.add(id(node))
            if node.doubt:  # None where it is taken back
                node.doubt, node.name = None, node.name.removesuffix(DOUBT)
            node = node.parent
    while stack:
        one, doubt = stack.pop()
        doubt = doubt or one.doubt is not False
        if one.content:
            if not doubt or one.name.startswith("main"):
                take_back(one, found)
            else:
                others.append(one)
        stack.extend((p, doubt) for p in one.parts if isinstance(p, Node) and not _is_noise(p, False))
    if not found:
        around = set()
        for one in others:
            take_back(one, around)
    return found


def _flow(node: Node, in_content: bool, left_out):
    """Text and blocks of an element, None where a block is left out; inline
    elements are part of the text."""
    stack = list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            yield part
        elif _is_noise(part, in_content) or part.doubt and (part.named or left_out(part)):
            if part.tag not in INLINE:
                yield None
        elif part.tag in INLINE and not part.content:
            yield " " if part.tag == "br" else ""
            stack.extend(reversed(part.parts))
        else:
            yield part


def _clean(text: str) -> str:
    return " ".join(_html.unescape(text).split())


def walk(root: Node):
    """(path, child names, own text) of the blocks that presentation alone
    doesn't rule out."""
    marked = _marked(root)
    stack = [(root, "", False)]
    while stack:
        node, path, in_content = stack.pop()
        in_content = in_content or node.content
        doubtful = []  # left out of the text here, and asked like blocks
        flow = list(_flow(node, in_content, lambda p: doubtful.append(p) or True))
        kids = [p for p in flow if isinstance(p, Node)] + doubtful
        if path and (in_content or not marked):
            yield path, [k.name for k in kids], _clean("".join(p if isinstance(p, str) else " " for p in flow))
        stack.extend((k, f"{path}>{k.name}", in_content) for k in kids)


def main_text(root: Node, cut: frozenset[str] = frozenset(), keep: frozenset[str] = frozenset()) -> str:
    """Blocks of the branches that stay. Elements are left out by
    presentation, unless their path is in ``keep``, by their path in ``cut``,
    and, where the page marks its content, outside it."""
    marked, blocks, open_ = _marked(root), [], []

    def close():
        text = _clean("".join(open_))
        if text:
            blocks.append(text)
        open_.clear()

    stack = [(root, "", False)]
    while stack:
        node, path, in_content = stack.pop()
        if node is None:
            close()
        elif isinstance(node, str):
            if in_content or not marked:
                open_.append(node)
        else:
            close()
            if path not in cut or id(node) in marked:
                in_content = in_content or node.content
                stack.append((None, "", False))
                for p in reversed(list(_flow(node, in_content, lambda p: f"{path}>{p.name}" not in keep))):
                    stack.append((p, f"{path}>{p.name}" if isinstance(p, Node) else "", in_content))
    close()
    return "\n\n".join(blocks)


# -- Site style tree ------------------------------------------------------------------

def _hash(*parts: str) -> int:
    h = xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _styles(batches):
    """Per page and path: the way it is shown (kind 0) and its texts (1)."""
    seen = set()
    for batch in batches:
        out = [[] for _ in range(6)]
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            copy = _hash(host, source)
            if copy in seen:  # adds no row; other copies fall to the grouping by page
                continue
            if len(seen) < 1 << 20:
                seen.add(copy)
            root = parse(source)
            page = _hash(host, main_text(root))
            shown, texts = {}, {}
            for path, kids, text in walk(root):
                shown.setdefault(path, set()).add(">".join(kids))
                if text:
                    texts.setdefault(path, set()).add(text)
            for path, ways in shown.items():
                node = _hash(host, path)
                rows = [(host, path, node, 0, _hash(*sorted(ways)), page)]
                rows += [(None, None, node, 1, _hash(t), page) for t in texts.get(path, ())]
                for row in rows:
                    for column, value in zip(out, row):
                        column.append(value)
        types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["host", "path", "node", "kind", "value", "page"])


def _is_root(path: str) -> bool:
    """Whether a path ends in an element that marks the content."""
    return path.rpartition(">")[2].partition(".")[0] in CONTENT_TAGS


def _score(path: str, value: float, m: float | None) -> float:
    """Importance, moved towards the prior by what m pages leave uncertain."""
    if m is None or _is_root(path):
        return value
    prior = 0.0 if f"{DOUBT}>" in path + ">" else 1.0
    return value + (prior - value) / (m * m)


def importance(paths: list[tuple[str, float, float | None]], gamma: float = GAMMA, pages: dict[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """(composite importance, highest score at or below) by path, from (path,
    presentation, content or None) and the number of pages of each path;
    without one the score is the importance."""
    own, pages = {p: (shown, text) for p, shown, text in paths}, pages or {}
    kids: dict[str, list[str]] = {}
    for p in own:
        kids.setdefault(p.rpartition(">")[0], []).append(p)
    out = {}
    for p in sorted(own, key=lambda x: -x.count(">")):
        shown, text = own[p]
        below = [out[k] for k in kids.get(p, ())]
        branches = [b[0] for b in below] + ([text] if text is not None else [])
        shown = 0.0 if p.endswith(DOUBT) else shown
        value = (1 - gamma) * shown + gamma * (sum(branches) / len(branches)) if branches else shown
        value = 1.0 if _is_root(p) else value
        out[p] = value, max([_score(p, value, pages.get(p)), *(b[1] for b in below)])
    return out


def _cuts(threshold: float, gamma: float):
    def run(group: pa.Table) -> pa.Table:
        rows = list(zip(*(group.column(c).to_pylist() for c in ("path", "shown", "text"))))
        pages = dict(zip(group.column("path").to_pylist(), group.column("m").to_pylist()))
        value = importance(rows, gamma, pages)
        low = {p for p, (_, top) in value.items() if top < threshold}
        cut = sorted(p for p in low if p.rpartition(">")[0] not in low)
        keep = sorted(p for p, (own, _) in value.items() if p.endswith(DOUBT) and _score(p, own, pages[p]) >= threshold)
        any_ = bool(cut or keep)
        return pa.table({"site": pa.array([group.column("host")[0].as_py()] * any_, pa.string()),
                         "cut": pa.array([cut] * any_, pa.list_(pa.string())), "keep": pa.array([keep] * any_, pa.list_(pa.string()))})
    return run


def style_cuts(pages: DataFrame, threshold: float = THRESHOLD, gamma: float = GAMMA, min_pages: int = MIN_PAGES) -> DataFrame:
    """Low-importance branches by host, and those that are kept in spite of
    their class words, from columns host and html: site, cut and keep (paths).
    Hosts without any have no row."""
    rows = pages.filter("host <> ''").select("host", "html").mapInArrow(
        _styles, "host string, path string, node long, kind int, value long, page long")
    # Each page's texts, and one way (the least) in which its copies show a path.
    way = F.when(F.col("kind") == 1, F.col("value")).alias("text")
    rows = rows.groupBy("node", "kind", "page", "host", "path", way).agg(F.min("value").alias("value"))
    pages_with = rows.groupBy("node", "kind", "value").agg(
        F.count(F.lit(1)).alias("k"), F.first("host").alias("host"), F.first("path").alias("path"))
    k, style = F.col("k").cast("double"), F.col("kind") == 0
    nodes = pages_with.groupBy("node").agg(
        F.sum(F.when(style, k)).alias("m"), F.sum(F.when(style, k * F.log(k))).alias("klogk"),
        F.sum(F.when(~style, F.log(k))).alias("logk"), F.count(F.when(~style, 1)).alias("texts"),
        F.max("host").alias("host"), F.max("path").alias("path")).filter(F.col("m") >= max(2, min_pages))
    m = F.col("m")
    nodes = nodes.select("host", "path", "m", (1 - F.col("klogk") / (m * F.log(m))).alias("shown"),
                         F.when(F.col("texts") > 0, 1 - F.col("logk") / (F.col("texts") * F.log(m))).alias("text"))
    return nodes.groupBy("host").applyInArrow(_cuts(threshold, gamma), "site string, cut array<string>, keep array<string>")


def _extract(batches):
    for batch in batches:
        text = []
        for source, cut, keep in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            text.append(main_text(parse(source), frozenset(cut or ()), frozenset(keep or ())) if source else "")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], ["id", "url", "text"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 threshold: float = THRESHOLD, gamma: float = GAMMA, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per input row: id, url, text."""
    row = F.col("row")
    source = nested_row(pages).select(row.getField(id_col).alias("id"), row.getField(url_col).cast("string").alias("url"),
                                      F.coalesce(row.getField(html_col).cast("string"), F.lit("")).alias("html"))
    kind = source.schema["id"].dataType.simpleString()
    host = ascii_lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
    source = source.withColumn("host", host)
    # One row per host that loses or regains a branch. Spark broadcasts the table where
    # its size on disk allows, and joins by shuffle beyond that.
    cuts = stored(style_cuts(source, threshold, gamma, min_pages), "style-cuts")
    joined = source.join(cuts, F.col("host") == F.col("site"), "left").select("id", "url", "html", "cut", "keep")
    return joined.mapInArrow(_extract, f"id {kind}, url string, text string")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
