"""URL filter on a sorted, memory-mapped array of 64-bit xxhash keys.

A list of rules (host and path, like ``example.org/es/``) is laid out in one
file: the sorted xxhash keys of the rule strings, then verdicts, string offsets
and the strings. The file is written to the shared folder and handed to every
executor with ``SparkContext.addFile``; its tasks map it, so a host has one copy
in its page cache. Each url gives the candidate strings "host or parent domain"
+ "path prefix as long as some rule's"; a batch's candidates are hashed, found
by one vectorised binary search, and confirmed against the stored strings, so a
colliding key never decides.

Defined results: the host is what stands after the first ``://`` up to ``/``,
``?``, ``#`` or the end, with A-Z lower-cased; the path follows up to ``?``,
``#`` or the end. A null url, or one without ``://``, has an empty host and path
and no rule. A rule fits its host and all subdomains where the path starts with
the rule's path; of several the longest wins (host and path together; of equal
length the longer host, and of rules given twice the first). A url that is not
in the list gets ``default``. Rows are never moved or dropped; null ids, ties
and repeated rows are returned as they come, and other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import ascii_lower, nested_row, table
from sparkprep.session import shared_path

_VERDICTS = ("allow", "block")


def _keys(strings: list[bytes]) -> np.ndarray:
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(s) for s in strings), np.uint64, len(strings))


def pack_rules(rules: list[tuple[str, str]]) -> bytes:
    """The file's bytes for (verdict, rule) pairs; a rule is host + path."""
    first: dict[bytes, int] = {}
    for verdict, rule in rules:
        first.setdefault(rule.encode(), _VERDICTS.index(verdict))
    texts = list(first)
    keys = _keys(texts)
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order]
    verdicts = np.array([first[t] for t in texts], np.uint8)
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    lengths = np.unique([len(t.decode()) - t.decode().index("/") if b"/" in t else 0 for t in texts]).astype(np.int64)
    head = np.array([len(texts), len(lengths)], np.int64)
    return b"".join(x.tobytes() for x in (head, keys[order], ends, lengths, verdicts)) + b"".join(texts)


class RuleArray:
    """The mapped file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, m = (int(x) for x in raw[:16].view(np.int64))
        cut = np.cumsum([16, 8 * n, 8 * (n + 1), 8 * m, n])
        self.keys = raw[cut[0]:cut[1]].view(np.uint64)
        self.ends = raw[cut[1]:cut[2]].view(np.int64)
        self.path_lengths = raw[cut[2]:cut[3]].view(np.int64).tolist()
        self.verdicts, self.texts = raw[cut[3]:cut[4]], raw[cut[4]:]

    def find(self, strings: list[bytes]) -> np.ndarray:
        """Number of each string's rule, or -1."""
        probes = _keys(strings)
        at = np.searchsorted(self.keys, probes)
        out = np.full(len(strings), -1, np.int64)
        alive = np.arange(len(strings))
        while len(alive):  # one turn for each rule that shares the key
            alive = alive[at[alive] < len(self.keys)]
            alive = alive[self.keys[at[alive]] == probes[alive]]
            same = np.array([self.text(at[i]) == strings[i] for i in alive], bool)
            out[alive[same]] = at[alive[same]]
            alive = alive[~same] if len(alive) else alive
            at[alive] += 1
        return out

    def text(self, i: int) -> bytes:
        return self.texts[self.ends[i]:self.ends[i + 1]].tobytes()


def _candidates(host: str, path: str, lengths: list[int]):
    """(string, length) for every parent domain and path prefix."""
    labels = host.split(".")
    for i in range(len(labels)):
        domain = ".".join(labels[i:])
        if domain:
            for n in lengths:
                if n <= len(path):
                    yield (domain + path[:n]).encode("utf-8", "surrogatepass"), len(domain) + n


_open: dict[str, RuleArray] = {}


def _judge(name: str, default: str):
    def run(batches):
        if name not in _open:
            _open[name] = RuleArray(SparkFiles.get(name))
        rules = _open[name]
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [list(_candidates(h, p, rules.path_lengths)) for h, p in zip(hosts, paths)]
            strings = [c[0] for cs in found for c in cs]
            hit = rules.find(strings)
            rule, verdict, at = [], [], 0
            for cs in found:
                best, longest = -1, -1
                for k, (_, n) in enumerate(cs, at):
                    if hit[k] >= 0 and n > longest:
                        best, longest = int(hit[k]), n
                at += len(cs)
                rule.append(rules.text(best).decode() if best >= 0 else None)
                verdict.append(_VERDICTS[rules.verdicts[best]] if best >= 0 else default)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             ["id", "host", "path", "rule", "verdict"])
    return run


def _share(spark: SparkSession, data: bytes) -> str:
    """Name under which every task can open the file."""
    name = f"url-rules-{hashlib.sha1(data).hexdigest()}.bin"
    if not any(str(x).endswith(name) for x in spark.sparkContext.listFiles):
        folder = shared_path(spark, "url-rules")
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        out = fs.create(target, True)
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i:i + (1 << 20)]))
        out.close()
        spark.sparkContext.addFile(fs.makeQualified(target).toString())
    return name


def judge_urls(urls: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (or null), verdict. The
    rules are (verdict, host + path) pairs."""
    rows = nested_row(urls)
    url = F.coalesce(F.col("row").getField(url_col).cast("string"), F.lit(""))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    split = rows.select(F.col("row").getField(id_col).alias("id"),
                        ascii_lower(F.regexp_extract(url, parts, 1)).alias("host"),
                        F.regexp_extract(url, parts, 2).alias("path"))
    kind = split.schema["id"].dataType.simpleString()
    name = _share(urls.sparkSession, pack_rules(rules))
    return split.mapInArrow(_judge(name, default), f"id {kind}, host string, path string, rule string, verdict string")


# The rules of op10, as (verdict, host + path).
OP10_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), OP10_RULES).withColumnRenamed("id", "page_id")


OP10_SQL = """
WITH p AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM pages),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM p LEFT JOIN r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY ALL
"""
