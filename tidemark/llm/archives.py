"""Legacy ARC archives to WARC, with revisit records for repeated payloads.

``write_arc`` puts pages into ARC files of version 1 and 2 in turn. ``convert`` parses them (a version block first, then
header lines of that version whose last field is the declared length) and writes
WARC files with synthesised record ids, dates, types and digests. ``read_warc``
parses those. Files are written and read by Spark, so any file system will do; one
file holds about ``FILE_BYTES`` or one larger page, which bounds what a task holds.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the
smallest page id is the response, the others are revisits of it (ties: the first in
its archive; null ids last). Smaller payloads are always responses.

Defined results: null html is an empty payload; a null url becomes ``urn:page:<id>``;
white space and non-ASCII characters of a url are percent-encoded; every input row is
a record, also when ids repeat; an empty table gives an empty result; a header line or
length that can't be parsed raises ValueError with the file and byte offset.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

FILE_BYTES = 32 << 20
LEAST_REVISIT = 100
CREATED = "19990101000000"

#: The field lists of ARC header lines and the profile URI of the WARC standard.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Record(NamedTuple):
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    at: int


def unzip(content: bytes) -> bytes:
    """Plain bytes of a file of any number of gzip members, or of a file that isn't zipped."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def arc_head(version: int, name: str) -> bytes:
    body = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n".encode()
    more = {1: "", 2: "200 - - 0 - "}[version]
    return f"filedesc://{name} 0.0.0.0 {CREATED} text/plain {more}{len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, at: int, url: str, block: bytes) -> bytes:
    more = "" if version == 1 else f"200 {hashlib.md5(block).hexdigest()} - {at} {name} "
    return f"{url} 0.0.0.0 {CREATED} text/html {more}{len(block)}\n".encode() + block + b"\n"


def parse_arc(data: bytes, name: str = "") -> Iterator[Record]:
    """The records of an ARC file after its version block."""
    at, fields = 0, 0
    while at < len(data):
        if data[at] == 0x0A:  # the line feed between records
            at += 1
            continue
        stop = data.find(b"\n", at)
        head = data[at:stop].decode("utf-8", "replace").split(" ") if stop >= 0 else []
        first = not fields
        if (not first and len(head) != fields) or not head or not head[-1].isdigit() or stop + 1 + int(head[-1]) > len(data):
            raise ValueError(f"{name}: no ARC record at byte {at}")
        block = data[stop + 1:stop + 1 + int(head[-1])]
        if first:
            version = block[:1]
            if not head[0].startswith("filedesc://") or version not in (b"1", b"2"):
                raise ValueError(f"{name}: no ARC version block at byte {at}")
            fields = len(ARC_FIELDS[int(version)].split())
        else:
            yield Record(head[0], head[1], head[2], head[3], block, at)
        at = stop + 1 + len(block)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with their blank line, and the payload."""
    cut = block.find(b"\r\n\r\n")
    return (block[:cut + 4], block[cut + 4:]) if cut >= 0 and block.startswith(b"HTTP/") else (b"", block)


def page_id_of(headers: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", headers)
    return int(found[1]) if found else None


def record_id(kind: str, page_id: int | None, digest: str, more: str = "") -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{kind} {page_id} {digest} {more}").urn


def warc_record(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def convert_record(r: Record, name: str, refers: tuple[int | None] | None) -> bytes:
    """The WARC record of an ARC record; ``refers``: page id of the response that it revisits."""
    headers, payload = split_http(r.block)
    digest, page_id = hashlib.sha256(payload).hexdigest(), page_id_of(headers)
    d = r.date.ljust(14, "0")
    head = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id('response', page_id, digest)}>")]
    block = r.block
    if refers is not None:
        block = headers
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id('revisit', page_id, digest, f'{name} {r.at}')}>"),
                ("WARC-Refers-To", f"<{record_id('response', refers[0], digest)}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return warc_record([*head, ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
                        ("WARC-Target-URI", r.url), ("WARC-IP-Address", r.ip),
                        ("WARC-Payload-Digest", f"sha256:{digest}"),
                        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
                        ("Content-Type", "application/http; msgtype=response" if headers else r.mime)], block)


def parse_warc(data: bytes, name: str = "") -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n") if stop >= 0 else [""]
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = head.get("content-length", "")
        if not lines[0].startswith("WARC/") or not size.isdigit() or stop + 4 + int(size) > len(data):
            raise ValueError(f"{name}: no WARC record at byte {at}")
        yield head, data[stop + 4:stop + 4 + int(size)]
        at = stop + 4 + int(size)


def one_file(content: bytes) -> pa.RecordBatch:
    """A row that the text writer puts into a file as it is, whatever its bytes; the writer adds the last line feed."""
    return pa.record_batch([pa.array([content[:-1]], pa.binary()).view(pa.string())], names=["value"])


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, made, held, size = TaskContext.get().partitionId(), 0, [], 0
    out = lambda: one_file(b"".join(held))
    for b in batches:
        for lo in range(0, b.num_rows, 64):
            for page_id, url, html in zip(*(c.to_pylist() for c in b.slice(lo, 64).columns), strict=True):
                payload = (html or "").encode()
                if held and size + len(payload) > FILE_BYTES:
                    yield out()
                    made, held, size = made + 1, [], 0
                version, name = 1 + (task + made) % 2, f"pages-{task:06d}-{made:05d}"
                if not held:
                    held.append(arc_head(version, name))
                mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                block = f"HTTP/1.0 200 OK\r\n{mark}Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
                clean = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
                held.append(arc_record(version, name, size, clean, block))
                size += len(held[-1])
    if held:
        yield out()


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Gzipped ARC files below ``path``; each row of the written frame is one file."""
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    rows.mapInArrow(_to_arc, "value string").write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true") \
        .load(path).select("path", "content")


_INDEX = pa.schema([("path", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            path, rows = b.column(0)[k].as_py(), []
            for r in parse_arc(unzip(b.column(1)[k].as_py()), path):
                headers, payload = split_http(r.block)
                rows.append((path, r.at, page_id_of(headers), hashlib.sha256(payload).hexdigest(), len(payload)))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, _INDEX, strict=True)], schema=_INDEX)


def read_arc_index(spark: SparkSession, path: str) -> DataFrame:
    """path, at, page_id, payload_digest, payload_bytes of every record."""
    return files(spark, path).mapInArrow(_index, "path string, at long, page_id long, payload_digest string, payload_bytes long")


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            path = b.column(0)[k].as_py()
            revisits = {x["at"]: (x["refers_to"],) for x in b.column(2)[k].as_py() or ()}
            out = [warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{record_id('warcinfo', None, '', path)}>"),
                                ("WARC-Date", f"{CREATED[:4]}-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")],
                               b"software: tidemark\r\nformat: WARC File Format 1.1\r\n")]
            out += [convert_record(r, path, revisits.get(r.at)) for r in parse_arc(unzip(b.column(1)[k].as_py()), path)]
            yield one_file(b"".join(out))


def convert(spark: SparkSession, arc_path: str, warc_path: str, s: Scratch) -> None:
    """Write a WARC file for every ARC file."""
    index = s.save(read_arc_index(spark, arc_path), "index")
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "at")
    firsts = (index.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("payload_digest")
              .agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    revisits = (index.where(F.col("payload_bytes") >= LEAST_REVISIT).join(firsts, "payload_digest")
                .where(~((F.col("path") == F.col("first.path")) & (F.col("at") == F.col("first.at"))))
                .groupBy("path").agg(F.collect_list(F.struct("at", F.col("first.page_id").alias("refers_to"))).alias("revisits")))
    (files(spark, arc_path).join(revisits, "path", "left").select("path", "content", "revisits")
     .mapInArrow(_to_warc, "value string").write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(warc_path))


_READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_id", pa.string()), ("page_id", pa.int64()),
                   ("url", pa.string()), ("warc_date", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64())])


def _from_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            rows = []
            for head, block in parse_warc(unzip(b.column(1)[k].as_py()), b.column(0)[k].as_py()):
                kind = head.get("warc-type")
                if kind in ("response", "revisit"):
                    headers, payload = split_http(block)
                    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else head["warc-payload-digest"].rpartition(":")[2]
                    rows.append((head["warc-record-id"], kind, head.get("warc-refers-to"), page_id_of(headers), head.get("warc-target-uri"),
                                 head["warc-date"], digest, len(payload) if kind == "response" else None))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 8, _READ, strict=True)], schema=_READ)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit; a response's digest and length are taken from its bytes."""
    return files(spark, path).mapInArrow(_from_warc, "record_id string, record_type string, refers_id string, page_id long, url string, "
                                                     "warc_date string, payload_digest string, payload_bytes long")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages -> ARC -> WARC -> page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_id."""
    spark = pages.sparkSession
    s = Scratch(spark, "archives")
    arc, warc = s.path("arc"), s.path("warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    convert(spark, arc, warc, s)
    read = s.save(read_warc(spark, warc), "records")
    seen = read.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"))
    revisits = read.where("record_type = 'revisit'").join(seen, "refers_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id"]
    return (read.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(columns)
            .union(revisits.withColumn("payload_bytes", F.col("_bytes")).select(columns)))
