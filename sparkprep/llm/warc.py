"""WARC archives: writing captures, reading records, assembling transactions.

Every capture is written as a request, a response (or, for a payload already
held by a smaller id, an identical-payload-digest revisit) and a metadata
record. Records end with two CR LF, which the text writer adds as its line
separator, so Spark writes and compresses the archives straight to any file
system. They are read back the same way: the text reader gives the pieces
between double line ends in file order, and a small state machine per file puts
records together by their Content-Length, holding one record at a time. A file is read by
one task, compressed or not: a split inside a record could not be told from text.

Transactions are assembled by joins over the WARC-Concurrent-To links, in
either direction and through at most one record in between, and give one nested
row per capture. Only record headers and digests move; payloads are hashed
where they are read and are carried along only if asked for.

Defined results: null html is an empty payload. Payloads of at least
``min_bytes`` bytes that are equal have one response, at the smallest id; others
refer to it. Rows with a null id are all responses and nothing refers to them;
rows that are equal in id and payload write equal records and are all returned.
A null url has no WARC-Target-URI. A record that is cut off at the end of a file is left out.
An empty table gives no archive rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import nested_row, stored, table
from sparkprep.session import shared_path

END = "\r\n\r\n"
MIN_BYTES = 0
RECORD = ("type string, record_id string, concurrent_to array<string>, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, fields map<string,string>, payload binary")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _base32(hex_):
    """Bare upper-case base32 of a 40-digit hex column."""
    parts = [F.lpad(F.conv(F.substring(hex_, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(kind: str, key):
    h = F.md5(F.concat(F.lit(kind + ":"), key))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                                                     F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


# -- Writing ---------------------------------------------------------------------------

def _text(s: str) -> bytes:
    return s.encode("utf-8", "surrogatepass")


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in headers if v), f"Content-Length: {len(block)}"]
    return _text("\r\n".join(lines) + END) + block


def _write(date: str):
    def run(batches):
        for batch in batches:
            out = []
            for id_, url, payload, digest, own, req, meta, first, first_rid in zip(*(batch.column(i).to_pylist() for i in range(9))):
                payload = payload or b""
                uri = [("WARC-Target-URI", url), ("WARC-Date", date)]
                path = "/" + (url or "").partition("://")[2].partition("/")[2]
                out.append(_record([("WARC-Type", "request"), ("WARC-Record-ID", req), ("WARC-Concurrent-To", own), *uri,
                                    ("Content-Type", "application/http; msgtype=request")], _text(f"GET {' '.join(path.split())} HTTP/1.1{END}")))
                head = _text(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}")
                both = [("WARC-Record-ID", own), *uri, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
                if first_rid is None:
                    out.append(_record([("WARC-Type", "response"), *both], head + payload))
                else:
                    out.append(_record([("WARC-Type", "revisit"), *both, ("WARC-Refers-To", first_rid), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], head))
                known = [("id", id_), ("refers-to-id", first), ("payload-bytes", len(payload))]
                out.append(_record([("WARC-Type", "metadata"), ("WARC-Record-ID", meta), ("WARC-Concurrent-To", own), *uri, ("Content-Type", "application/warc-fields")],
                                   _text("".join(f"{k}: {v}\r\n" for k, v in known if v is not None))))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the captures of all rows as gzipped WARC files under ``path``."""
    row = F.col("row")
    source = nested_row(pages).select(row.getField(id_col).alias("id"), row.getField(url_col).cast("string").alias("url"),
                                      F.coalesce(row.getField(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    source = source.withColumn("digest", F.sha1("payload"))
    # Digests that several rows have, with the smallest id.
    groups = stored(source.filter((F.octet_length("payload") >= min_bytes) & F.col("id").isNotNull()).groupBy("digest")
                    .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
                    .select(F.col("digest").alias("key"), "first"), "payloads")
    joined = source.join(groups, F.col("digest") == F.col("key"), "left")
    again = F.col("id") > F.col("first")
    # Rows without an id get a number instead.
    key = F.concat_ws(":", F.col("id").cast("string"), "digest", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
    named = joined.select(
        F.col("id").cast("string"), "url", "payload", _base32(F.col("digest")).alias("digest"), _uuid("capture", key).alias("own"),
        _uuid("request", key).alias("req"), _uuid("metadata", key).alias("meta"), F.when(again, F.col("first").cast("string")).alias("first"),
        F.when(again, _uuid("capture", F.concat_ws(":", F.col("first").cast("string"), F.col("digest")))).alias("first_rid"))
    (named.mapInArrow(_write(date), "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").text(path))


# -- Reading ----------------------------------------------------------------------------

def _fields(block: bytes) -> list[tuple[str, str]]:
    out = []
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, sep, value = line.partition(":")
        if sep:
            out.append((name.strip(), value.strip()))
    return out


def _parse(head: bytes, block: bytes, with_payload: bool):
    pairs = _fields(head)
    named = {k.lower(): v for k, v in pairs}
    kind = named.get("warc-type", "")
    fields, payload, digest, size = [], None, None, None
    if named.get("content-type", "").startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        fields = _fields(http)
        digest = (named.get("warc-payload-digest") or "").rpartition(":")[2] or None
        if kind == "response":
            digest, size = sha1_base32(payload), len(payload)
    elif named.get("content-type") == "application/warc-fields":
        fields = _fields(block)
    else:
        payload = block
    return (kind, named.get("warc-record-id"), [v for k, v in pairs if k.lower() == "warc-concurrent-to"], named.get("warc-target-uri"),
            named.get("warc-refers-to"), digest, size, [(k.lower(), v) for k, v in dict(fields).items()], payload if with_payload else None)


_TYPES = (pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary())
_NAMES = [x.strip().split(" ")[0] for x in RECORD.replace("map<string,string>", "map").split(",")]
_GLUE = END.encode()


def _read(with_payload: bool):
    def run(batches):
        # The file's bytes that no record has taken yet, and the record whose
        # block they begin with.
        file, held, have, head, want = None, [], 0, None, 0
        for batch in batches:
            rows = []
            for path, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != file:
                    file, held, have, head = path, [], 0, None
                else:
                    held.append(_GLUE)
                    have += len(_GLUE)
                held.append(piece or b"")
                have += len(held[-1])
                while head is None or have >= want:
                    data = b"".join(held)
                    if head is None:
                        data = data.lstrip(b"\r\n")
                        head, found, rest = data.partition(_GLUE)
                        if not found:
                            held, have, head = [data], len(data), None
                            break
                        want = int(dict((k.lower(), v) for k, v in _fields(head)).get("content-length", "0"))
                        held, have = [rest], len(rest)
                    else:
                        rows.append(_parse(head, data[:want], with_payload))
                        held, have, head = [data[want:]], len(data) - want, None
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], _NAMES)
    return run


def _unsplit(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that reads a file as one split."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, str(1 << 62))
    return own


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all WARC files under ``path``."""
    lines = _unsplit(spark).read.option("lineSep", END).text(path)
    whole = F.when(F.col("_metadata.file_block_start") == 0, F.col("value")).otherwise(F.raise_error(F.lit("a WARC file was split")))
    pieces = DataFrame(lines.select(F.col("_metadata.file_path"), whole.cast("binary").alias("value"))._jdf, spark)
    return pieces.mapInArrow(_read(with_payload), RECORD)


# -- Transactions -------------------------------------------------------------------------

def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: capture_id and the structs response (a response or
    revisit), request and metadata, found by concurrent-to links. Of several
    requests or metadata records the smallest record id is taken."""
    records = stored(records, "records")
    link = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    both = link.union(link.select("b", "a")).toDF("near", "far").distinct()
    captures = records.filter("type IN ('response', 'revisit')")
    others = records.filter("type IN ('request', 'metadata')")
    ids = captures.select(F.col("record_id").alias("capture"))
    one = ids.join(both, F.col("capture") == F.col("near")).select("capture", F.col("far").alias("member"))
    two = one.join(both, F.col("member") == F.col("near")).filter("far <> capture").select("capture", F.col("far").alias("member"))
    members = one.union(two).distinct().join(others.withColumnRenamed("record_id", "rid"), F.col("member") == F.col("rid"))
    body = F.struct("rid", "concurrent_to", "target_uri", "fields")
    per = members.groupBy("capture").agg(*(F.min_by(F.when(F.col("type") == t, body), F.when(F.col("type") == t, F.col("rid"))).alias(t) for t in ("request", "metadata")))
    response = F.struct("type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "fields", "payload")
    return (captures.select(F.col("record_id").alias("capture_id"), response.alias("response"))
            .join(per, F.col("capture_id") == F.col("capture"), "left").select("capture_id", "response", "request", "metadata"))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    rows = assemble(read_warc(spark, path, with_payload=False))
    known, response = F.col("metadata.fields"), F.col("response")
    return rows.select(known["id"].cast("long").alias("page_id"),
                       F.coalesce(response["payload_bytes"], known["payload-bytes"].cast("long")).alias("payload_bytes"),
                       response["payload_digest"].alias("payload_digest"), response["type"].alias("record_type"),
                       known["refers-to-id"].cast("long").alias("refers_to"))


OP5_SQL = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM d),
x AS (SELECT page_id, n, first_id, [CAST('0x' || h[i:i+9] AS BIGINT) FOR i IN [1, 11, 21, 31]] AS v FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((y >> b) & 31) + 1 AS BIGINT), 1)
         FOR b IN [35, 30, 25, 20, 15, 10, 5, 0]] FOR y IN v]), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM x
"""
