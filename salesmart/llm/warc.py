"""WARC archives: written and read with Spark's own files, and captures put together from their
request, response and metadata records.

Writing. Each page becomes three records: the request, the response (or, where an equal payload
is stored under a smaller page id, a revisit without it) and the metadata record; request and
metadata name the response in WARC-Concurrent-To. The records are text rows of Spark's text
sink with the two line ends that close a WARC record as its separator, so the files are WARC
1.1, gzip-compressed, committed and retried as any Spark output and written to any store. A
payload is carried byte for byte.

Which page answers for a payload needs only digests: they are aggregated, payloads are not
moved. Payloads that occur once, the bulk, are not in that table at all; it is written first, so
the join with it is a broadcast only where its size on disk is below Spark's limit, else a
shuffle join whose hot digests the engine splits.

Reading. A file is parsed record by record by its Content-Length fields; memory is bounded by a
file, whose size the writer bounds by ``RECORDS_PER_FILE``.

Assembly. Records are joined through their concurrent-to identifiers, in either direction and
over several steps (metadata to request to response), then gathered into one nested row for each
capture. A hop joins only what no earlier hop has placed.

Defined results: a null payload is empty; null url and page id are written as absent fields and
read as null; repeated page rows are captures of their own (each with ids of its own); among
equal payloads each row with the least page id is a response; a null page id never answers for
another page (such a payload alone: every row is a response); an empty table writes no record and
reads as no capture; other columns are ignored. A record that reaches no response or revisit
becomes a capture without one, named by itself. An archive that is read twice gives captures with
their requests and metadata twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import stored

RECORDS_PER_FILE = 30_000
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
ANCHORS = ("response", "revisit", "resource", "conversion")
# Fixed value: RFC 4648 base 32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_EOL = "\r\n"

RECORD_SCHEMA = ("record_id string, warc_type string, concurrent_to array<string>, target_uri string, "
                 "warc_date string, payload_digest string, payload_bytes long, refers_to_uri string, "
                 "refers_to_id string, fields map<string,string>, http_status int, payload binary")


def sha1_base32(data: Column) -> Column:
    """Upper-case base 32 of the SHA-1 of a binary column (160 bits are 32 characters)."""
    digest = F.sha1(data)
    chars = []
    for k in range(0, 40, 5):                         # five hex digits are four characters
        group = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            chars.append(F.substring(F.lit(BASE32), F.shiftright(group, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*chars)


def _fields(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(_EOL)), F.lit(""))
                      for name, value in pairs))


def _record(kind: Column | str, rid: Column, block: Column, *pairs: tuple[str, Column]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = _fields(("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", F.lit(DATE)), *pairs,
                   ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1" + _EOL), head, F.lit(_EOL), block)


def _one_line(c: Column) -> Column:
    """A header value: line ends would end the header."""
    return F.regexp_replace(c, r"[\r\n]+", " ")


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write the three records of every page under ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    digests = rows.select("page_id", F.unhex(F.sha1("payload")).alias("sha"),
                          F.octet_length("payload").alias("bytes"))
    shared = stored(digests.where(F.col("bytes") >= min_revisit_bytes).groupBy("sha")
                    .agg(F.min("page_id").alias("answers"), F.count("*").alias("n"))
                    .where("n > 1 and answers is not null").select("sha", "answers"), "warc-shared")
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    rows = rows.join(shared, "sha", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("answers")) & F.col("answers").isNotNull(),
                         F.lit(False))

    def rid(kind: str) -> Column:
        h = F.md5(F.concat_ws("|", F.lit(kind), F.col("row_no").cast("string"),
                              F.coalesce(F.col("page_id").cast("string"), F.lit("-"))))
        return F.concat(F.lit("<urn:uuid:"), *(
            x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
            for x in ((F.lit("-") if a > 1 else F.lit("")), F.substring(h, a, n))), F.lit(">"))

    url = _one_line(F.col("url"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + _EOL + "Content-Type: text/html; charset=utf-8" + _EOL
                          + "Content-Length: "), F.octet_length("payload").cast("string"), F.lit(_EOL * 2))
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload").cast("string"))
    get = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1" + _EOL * 2))
    meta = _fields(("page-id", F.col("page_id").cast("string")))
    to = ("WARC-Concurrent-To", F.col("response_id"))
    uri = ("WARC-Target-URI", url)
    # the row number is drawn before the row is cut into records, so they share it
    rows = (rows.withColumn("revisit", revisit).withColumn("row_no", F.monotonically_increasing_id())
            .withColumn("digest", sha1_base32(F.col("payload"))).withColumn("response_id", rid("response")))
    records = F.array(
        _record("request", rid("request"), get, uri, to, ("Content-Type", F.lit("application/http; msgtype=request"))),
        _record(F.when(F.col("revisit"), "revisit").otherwise("response"), F.col("response_id"),
                F.concat(http, body), uri, ("WARC-Payload-Digest", digest),
                ("WARC-Profile", F.when(F.col("revisit"), F.lit(
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
                ("Content-Type", F.lit("application/http; msgtype=response"))),
        _record("metadata", rid("metadata"), meta, uri, to, ("Content-Type", F.lit("application/warc-fields"))))
    (rows.select(F.explode(records).alias("value")).write.option("lineSep", _EOL * 2)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path))


def parse(content: bytes) -> Iterator[dict]:
    """The records of one archive file, plain or gzip (of one or many members)."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = _header(f)
        block = f.read(int(_last(head, "content-length") or 0))
        yield _record_row(head, block)


def _header(f) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    while (line := f.readline()).strip():
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and out:                 # a folded line goes on with the field
            out[-1] = (out[-1][0], out[-1][1] + " " + text.strip())
        else:
            name, _, value = text.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def _last(head: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in reversed(head) if k == name), None)


def _record_row(head: list[tuple[str, str]], block: bytes) -> dict:
    kind = (_last(head, "warc-type") or "").lower()
    payload, status, size = block, None, None
    if (_last(head, "content-type") or "").lower().startswith("application/http"):
        f = io.BytesIO(block)
        first = f.readline().split()
        inner = _header(f)
        payload = f.read()
        if kind in ("response", "revisit") and len(first) > 1 and first[1].isdigit():
            status = int(first[1])
        if kind == "revisit" and (_last(inner, "content-length") or "").isdigit():
            size = int(_last(inner, "content-length"))
    fields = None
    if (_last(head, "content-type") or "").lower().startswith("application/warc-fields"):
        fields = dict(_header(io.BytesIO(block)))
    digest = _last(head, "warc-payload-digest")
    if kind != "revisit":
        size = len(payload)
        digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {"record_id": _last(head, "warc-record-id"), "warc_type": kind,
            "concurrent_to": [v for k, v in head if k == "warc-concurrent-to"],
            "target_uri": _last(head, "warc-target-uri"), "warc_date": _last(head, "warc-date"),
            "payload_digest": digest and digest.rpartition(":")[2].upper(), "payload_bytes": size,
            "refers_to_uri": _last(head, "warc-refers-to-target-uri"),
            "refers_to_id": _last(head, "warc-refers-to"), "fields": fields, "http_status": status,
            "payload": payload}


def read(spark: SparkSession, path: str, payloads: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per record, ``RECORD_SCHEMA``. Digest and size of a stored payload are those of the
    bytes read; a revisit has those that its header states. Without ``payloads`` that column is
    null."""
    schema = pa.schema([
        ("record_id", pa.string()), ("warc_type", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("target_uri", pa.string()), ("warc_date", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to_uri", pa.string()), ("refers_to_id", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("http_status", pa.int32()), ("payload", pa.binary())])

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for r in parse(content.as_py()):
                    if not payloads:
                        r["payload"] = None
                    r["fields"] = list(r["fields"].items()) if r["fields"] is not None else None
                    rows.append(r)
                    size += len(r["payload"] or b"") + 500
                    if size > batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return (spark.read.format("binaryFile").load(path).where("length > 0").select("content")
            .mapInArrow(run, RECORD_SCHEMA))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (or revisit), requests, metadata, others
    (arrays of the records, by record id). ``records`` is read several times: pass a stored
    table."""
    anchor = F.col("warc_type").isin(*ANCHORS)
    ids = records.where("record_id is not null").select("record_id", "warc_type", "concurrent_to")
    named = ids.select("record_id", F.explode("concurrent_to").alias("other")).where("other <> record_id")
    links = named.union(named.select("other", "record_id")).distinct()
    reached = ids.where(anchor).select("record_id", F.col("record_id").alias("capture_id")).distinct()
    placed, frontier, open_links = reached, reached, links
    rest = ids.where(~anchor).select("record_id").distinct()
    while True:
        hop = (rest.join(open_links, "record_id")
               .join(frontier.select(F.col("record_id").alias("other"), "capture_id"), "other")
               .groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
        frontier = stored(hop, "warc-hop")
        if frontier.isEmpty():
            break
        placed = placed.union(frontier)
        rest = stored(rest.join(frontier, "record_id", "left_anti"), "warc-open")
        if rest.isEmpty():
            break
    record = F.struct(*records.columns)
    kind = F.col("warc_type")
    rows = (records.join(placed, "record_id", "left")
            .withColumn("capture_id", F.coalesce("capture_id", "record_id", F.expr("uuid()"))))
    return rows.groupBy("capture_id").agg(
        F.any_value(F.when(anchor, record), ignoreNulls=True).alias("response"),
        F.sort_array(F.collect_list(F.when(kind == "request", _sortable(records)))).alias("requests"),
        F.sort_array(F.collect_list(F.when(kind == "metadata", _sortable(records)))).alias("metadata"),
        F.sort_array(F.collect_list(F.when(~kind.isin(*ANCHORS, "request", "metadata"), _sortable(records))))
        .alias("others"))


def _sortable(records: DataFrame) -> Column:
    """The record as a struct that can be ordered: its map of fields as sorted entries."""
    return F.struct(*(F.array_sort(F.map_entries(c)).alias(c) if kind.startswith("map") else F.col(c)
                      for c, kind in records.dtypes))
