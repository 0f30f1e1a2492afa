"""WARC archives: write one record per page, read archives back with salvage.

Writing uses Spark's text sink with the record terminator as line separator,
so archives are committed by Spark's own protocol and a lost executor only
repeats its task. Of pages with equal payloads of at least
``min_revisit_bytes``, the one with the smallest id is a ``response``; the
others are ``revisit`` records that refer to it and carry no payload.

Reading is a salvage reader: each record's version line, length, terminator
and block digest are checked. After a failed check it searches for the next
gzip member or version line, goes on from there, and reports the skipped
bytes as a quarantined gap. Plain archives and archives of gzip members are
both read.

Defined results: null html is an empty payload; a null url has no target
header. A null page id is written as ``null``, read as null, and never chosen
as the record to refer to; a payload found under null ids only is all
``response``. Rows repeating the smallest id of a payload are all
``response``; payloads are equal if their digests are. Empty tables give no records. Extra columns are ignored. A very long
page is an archive of its own and must stay below the 2 GB limit of a binary value. Gaps
are logged and counted by ``recovered``; the query fails if there are any.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareway.llm.common import materialize, small_batches, table
from fareway.session import scratch_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: base32 digits
END = "\r\n\r\n"
RECORD_SCHEMA = ("archive string, start long, stop long, gap string, record_type string, record_id string, "
                 "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary")
ARROW_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                          for n, t in (c.split() for c in RECORD_SCHEMA.split(", "))])


def base32_sha1(block: Column) -> Column:
    """Upper-case base32 SHA-1 of UTF-8 text, by built-in functions: 8 groups of 20 bits."""
    digest = F.sha1(F.encode(block, "UTF-8"))
    chars = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * g, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            chars.append(F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*chars)


def assign_types(spark: SparkSession, pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload facts, ``record_type`` and ``refers_to``.

    The smallest id per digest is aggregated map-side first and written; the
    join back is a plain equi-join, whose hot digests adaptive execution splits.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    facts = pages.select("page_id", "url", html.alias("payload"), F.octet_length(html).cast("long").alias("payload_bytes"),
                         base32_sha1(html).alias("payload_digest"))
    first = materialize(spark, facts.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("_n")).filter("_n > 1 and first_id is not null").drop("_n"),
        "warc-first")
    again = (F.col("payload_bytes") >= min_revisit_bytes) & F.col("first_id").isNotNull() & \
        ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (facts.join(first, "payload_digest", "left")
            .withColumn("record_type", F.when(again, F.lit("revisit")).otherwise(F.lit("response")))
            .withColumn("refers_to", F.when(again, F.col("first_id"))).drop("first_id"))


def escaped(url: Column) -> Column:
    """Space and control characters as percent codes, each on its own, so that no two URLs become one."""
    for code in range(33):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def record_text(now: str = "2024-01-01T00:00:00Z") -> Column:
    """One record without its terminator: version line, headers, blank line, block."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.when(F.col("url").rlike(r"[\x00-\x20]"), escaped(F.col("url"))).otherwise(F.col("url"))

    def urn(c: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))

    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")), F.lit(f"WARC-Date: {now}"),
        F.when(uri.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), uri)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), base32_sha1(block)),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("refers_to"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


#: Payloads up to so many bytes, and records per archive of these: an archive stays below about 64 MB, or has one record.
SIZES = ((16 << 10, 4096), (1 << 20, 64), (None, 1))


def write_archives(typed: DataFrame, path: str, sizes=SIZES) -> None:
    """Archives under ``path``, by payload size, so that no file outgrows what one task reads at a time."""
    low = -1
    for high, records in sizes:
        part = typed.filter(F.col("payload_bytes") > low)
        part = part if high is None else part.filter(F.col("payload_bytes") <= high)
        part.select(record_text().alias("value")).write.mode("append").option("lineSep", END).option(
            "maxRecordsPerFile", records).text(path)
        low = high


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _parse(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record at ``at`` and where it ends, or what is wrong with it."""
    if not _VERSION.match(data, at):
        return "no version line"
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        return "header not ended"
    head: dict[str, str] = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdecimal():
        return "no content length"
    start = head_end + 4
    stop = start + int(head["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "block not ended"
    block = data[start:stop]
    if "warc-block-digest" in head and head["warc-block-digest"].removeprefix("sha1:") != _sha1(block):
        return "block digest differs"
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = head.get("warc-type") == "revisit"
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http) if revisit else None
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    if not revisit:
        own = _sha1(payload)
        if digest and digest != own:
            return "payload digest differs"
        digest = own
    return {"record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
            "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
            "payload_digest": digest or None, "payload_bytes": int(length[1]) if length else len(payload),
            "payload": None if revisit else payload}, stop + 4


def _member(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record in the gzip member at ``at``. The member is fed in bounded views: what follows it is not copied."""
    z, parts, view, pos = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not z.eof and pos < len(data):
            parts.append(z.decompress(view[pos:pos + (64 << 10)]))
            pos += 64 << 10
    except zlib.error:
        return "bad gzip member"
    if not z.eof:
        return "gzip member not ended"
    got = _parse(inner := b"".join(parts), 0)
    if isinstance(got, str):
        return got
    return (got[0], min(pos, len(data)) - len(z.unused_data)) if got[1] == len(inner) else "bytes after the record"


def salvage(data: bytes) -> Iterator[dict]:
    """Records of one archive, and gaps (``gap`` holds the reason) for bytes that are none."""
    at = bad_from = 0
    why = None
    while at < len(data):
        if data.startswith(b"\x1f\x8b\x08", at):
            got = _member(data, at)
        else:
            got = _parse(data, at)
        if isinstance(got, str):
            if why is None:
                bad_from, why = at, got
            found = _NEXT.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if why is not None:
            yield {"start": bad_from, "stop": at, "gap": why}
            why = None
        yield got[0] | {"start": at, "stop": got[1]}
        at = got[1]
    if why is not None:
        yield {"start": bad_from, "stop": at, "gap": why}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                rows = []
                for r in salvage(data):
                    rows.append({"archive": name} | r)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)

    return files.mapInArrow(parse, RECORD_SCHEMA)


def page_id(urn: str) -> Column:
    """The id in ``<urn:page:ID>``; null where it is not a number."""
    return F.expr(f"try_cast(regexp_extract({urn}, 'urn:page:([^>]*)', 1) as bigint)")


def recovered(spark: SparkSession, path: str, log: str) -> tuple[DataFrame, int]:
    """Records of the archives under ``path``, without payloads, and the number of quarantined gaps, which are written
    to ``log`` (archive, start, stop, gap) whether there are any or not."""
    rows = materialize(spark, read_archives(spark, path).drop("payload"), "warc-records")
    gaps = rows.filter("gap is not null").select("archive", "start", "stop", "gap")
    gaps.write.mode("overwrite").json(log)
    return rows.filter("gap is null").drop("gap"), gaps.count()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path, log = scratch_path(spark, "warc"), scratch_path(spark, "warc-gaps")
    write_archives(assign_types(spark, table(spark, sf_dir, "pages")), path)
    records, gaps = recovered(spark, path, log)
    if gaps:  # archives just written: a gap means that pages are missing from the result
        raise RuntimeError(f"{gaps} damaged ranges in the archives, listed in {log}")
    return records.select(
        page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_id("refers_to").alias("refers_to"))
