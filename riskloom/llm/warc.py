"""WARC: writing captures as archives, reading archives, assembling transactions.

A capture is three records: a response (or a revisit of an earlier one with the same
payload), a request and a metadata record, the last two pointing to the first by
WARC-Concurrent-To. Archives are written by Spark's committed text writer with the
record end as line separator, so they are plain WARC files on any Hadoop file
system, in files of a bounded number of records; with gzip a file is one gzip
stream. The reader parses by Content-Length and checks payload digests.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, bounded_hint, write_table

END = "\r\n\r\n"
ANCHORS = ("response", "revisit", "resource")
RECORD_SCHEMA = ("record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, content_type string, "
                 "http_status int, fields map<string,string>, payload_bytes long, payload_digest string, payload binary")


def _uuid(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}|"), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, record_id: Column, uri: Column, date: str, headers: list[Column], content_type: str, block: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"), line("WARC-Record-ID", record_id), F.coalesce(line("WARC-Target-URI", uri), F.lit("")), F.lit(f"WARC-Date: {date}\r\n"),
        *headers, F.lit(f"Content-Type: {content_type}\r\n"), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_warc(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", revisit_from: int = 1000,
               date: str = "2024-01-01T00:00:00Z", records_per_file: int = 12_000, compression: str = "gzip") -> None:
    """Write a capture per row of ``pages``; the payload is the body in UTF-8 (null: empty).

    Of captures with equal payloads of at least ``revisit_from`` bytes, one with the largest
    id is the response, the others revisit it; smaller ones are all responses. Rows that are equal in id, url and
    body are captures of their own, told apart by a number in their record ids. A null url has no target header, line ends in a url are
    percent-encoded; a null id has no id field. An empty table writes no records; other columns are ignored.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    url = F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), body.alias("body"))
    rows = rows.select("id", "url", "body", F.sha1(F.col("body").cast("binary")).alias("digest"), F.octet_length("body").alias("size"))
    keyed = rows.withColumn("key", F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), "digest"))
    # one narrow row per distinct capture with its number of copies; bodies are not moved
    keys = write_table(keyed.groupBy("digest", "key", "id", "size").agg(F.count(F.lit(1)).alias("n")), "warc-keys")
    groups = (
        keys.where(F.col("size") >= revisit_from).groupBy("digest")
        .agg(F.max(F.struct("id", "key")).alias("first"), F.sum("n").alias("n")).where(F.col("n") > 1)
        .select("digest", F.col("first.key").alias("first_key"))
    )
    groups = write_table(groups, "warc-groups")
    copies = keys.where(F.col("n") > 1).select("key", "n")
    if copies.limit(1).count():
        # equal rows are brought together (combined map-side, however many) and dealt out again with numbers
        told = keyed.join(bounded_hint(copies), "key", "left")
        again = told.where(F.col("n").isNotNull()).dropDuplicates(["key"]).withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
        keyed = told.where(F.col("n").isNull()).withColumn("copy", F.lit(0)).unionByName(again).drop("n")
    else:
        keyed = keyed.withColumn("copy", F.lit(0))
    keyed = keyed.join(bounded_hint(groups), "digest", "left")  # AQE splits a hot digest where this is no broadcast
    revisit = F.col("first_key").isNotNull() & ((F.col("first_key") != F.col("key")) | (F.col("copy") > 0))
    keyed = keyed.withColumn("revisit", revisit).withColumn("key", F.when(F.col("copy") > 0, F.concat("key", F.lit("|"), F.col("copy").cast("string"))).otherwise(F.col("key")))
    uri, capture = F.col("url"), _uuid("capture", F.col("key"))
    revisit = F.col("revisit")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    response = _record("response", capture, uri, date, [digest], "application/http; msgtype=response", F.concat(http, F.col("body")))
    refers = F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _uuid("capture", F.col("first_key")), F.lit("\r\n"))
    again = _record("revisit", capture, uri, date, [digest, refers], "application/http; msgtype=response", http)
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), capture, F.lit("\r\n"))
    host = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z]+://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z]+://[^/?#]*([^#]*)", 1), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    request = _record("request", _uuid("request", F.col("key")), uri, date, [concurrent], "application/http; msgtype=request", ask)
    notes = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit("")), F.lit("fetchTimeMs: 0\r\n"))
    metadata = _record("metadata", _uuid("metadata", F.col("key")), uri, date, [concurrent], "application/warc-fields", notes)
    lines = keyed.select(F.explode(F.array(F.when(revisit, again).otherwise(response), request, metadata)).alias("value"))
    lines.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(out)


def inflate(data: bytes) -> bytes:
    """The contents of a file of any number of gzip members; other files as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        if not d.eof:
            raise ValueError("the gzip stream is cut off")
        data = d.unused_data
    return b"".join(out) if out else data


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of an uncompressed archive, by Content-Length."""
    at = 0
    while at < len(data):
        split = data.find(b"\r\n\r\n", at)
        if split < 0 or data[at: at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        names: dict[str, list[str]] = {}
        for line in data[at:split].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            names.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda n: names.get(n, [None])[0]  # noqa: E731, B023
        start = split + 4
        end = start + int(one("content-length") or 0)
        if data[end: end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        block, kind, status, fields = data[start:end], one("warc-type"), None, {}
        payload = block
        if (one("content-type") or "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            if head.startswith(b"HTTP/"):
                status = int(head.split(b" ", 2)[1])
        elif one("content-type") == "application/warc-fields":
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)}
        digest, declared = hashlib.sha1(payload).hexdigest(), one("warc-payload-digest")
        if kind == "response" and declared and declared.startswith("sha1:") and declared[5:] != digest:
            raise ValueError(f"the payload at byte {at} does not have its digest")
        if kind == "revisit":
            digest = (declared or "").removeprefix("sha1:") or None
        yield {"record_id": one("warc-record-id"), "type": kind, "target_uri": one("warc-target-uri"), "date": one("warc-date"), "concurrent_to": names.get("warc-concurrent-to", []),
               "refers_to": one("warc-refers-to"), "content_type": one("content-type"), "http_status": status, "fields": fields,
               "payload_bytes": None if kind == "revisit" else len(payload), "payload_digest": digest, "payload": payload}
        at = end + 4


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Every record of the archives at ``path``; without ``payload`` that column is null (its size and digest stay).

    A revisit has no payload of its own: its size is null and its digest the declared one.
    A damaged archive fails.
    """
    kinds = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.list_(pa.string())),
                       ("refers_to", pa.string()), ("content_type", pa.string()), ("http_status", pa.int32()), ("fields", pa.map_(pa.string(), pa.string())),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                held, size = [], 0
                for r in parse_records(inflate(data.as_py())):
                    size += len(r["payload"])
                    held.append({**r, "fields": list(r["fields"].items()), "payload": r["payload"] if payload else None})
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    files = spark.read.format("binaryFile").load(path).select("content")
    return arrow_map(files, fn, RECORD_SCHEMA)


def assemble_transactions(records: DataFrame, most_related: int = 1000) -> DataFrame:
    """One nested row per capture: (record_id, part, capture, requests, metadata).

    Captures are response, revisit and resource records; requests and metadata belong to those that a
    concurrent-to identifier of either side names, or that a request they name belongs to. Records with one id
    are one record. A capture with more than ``most_related`` others has rows ``part`` 0, 1, ... that share them
    (by a hash of their ids), so no row grows without bound. Others that belong to no capture are rows with
    a null ``record_id`` and ``capture``. Null ids belong to nothing.
    """
    # read several times, so stored once: leave payloads out where they are not needed
    records = write_table(records.dropDuplicates(["record_id"]), "warc-records")
    records = records.withColumn("all", F.struct(*records.columns))
    anchors = records.where(F.col("type").isin(*ANCHORS) & F.col("record_id").isNotNull())
    others = records.where(F.col("type").isin("request", "metadata"))
    links = others.select(F.col("record_id").alias("other"), F.explode("concurrent_to").alias("named")).unionByName(
        anchors.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("named")))
    direct = links.join(anchors.select(F.col("record_id").alias("named")), "named").select("other", F.col("named").alias("capture_id"))
    through = (
        links.join(direct.select(F.col("other").alias("named"), "capture_id"), "named").join(direct.select("other"), "other", "left_anti").select("other", "capture_id")
    )
    belongs = write_table(direct.unionByName(through).distinct(), "warc-belongs")
    counts = belongs.groupBy("capture_id").agg(F.ceil(F.count(F.lit(1)) / most_related).cast("int").alias("parts"))
    dealt = belongs.join(counts, "capture_id").select("other", "capture_id", F.pmod(F.xxhash64("other"), F.col("parts")).cast("int").alias("part"))
    related = dealt.join(others.select(F.col("record_id").alias("other"), "type", "all"), "other")
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.col("all"))), lambda a, b: F.when(a["record_id"] < b["record_id"], -1).otherwise(1))
    grouped = related.groupBy("capture_id", "part").agg(pick("request").alias("requests"), pick("metadata").alias("metadata"))
    none = F.array().cast(grouped.schema["requests"].dataType)
    whole = anchors.select("record_id", F.col("all").alias("capture")).join(grouped.withColumnRenamed("capture_id", "record_id"), "record_id", "left").select(
        "record_id", F.coalesce("part", F.lit(0)).alias("part"), "capture", F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata"))
    alone = others.join(belongs.select(F.col("other").alias("record_id")), "record_id", "left_anti").select(
        F.lit(None).cast("string").alias("record_id"), F.lit(0).alias("part"), F.lit(None).cast(whole.schema["capture"].dataType).alias("capture"),
        F.when(F.col("type") == "request", F.array("all")).otherwise(none).alias("requests"), F.when(F.col("type") == "metadata", F.array("all")).otherwise(none).alias("metadata"))
    return whole.unionByName(alone)
