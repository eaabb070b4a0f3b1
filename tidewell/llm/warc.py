"""WARC archives: a writer that leaves equal payloads out, and a reader that salvages.

The writer makes one record per page.  Of the records with equal payloads of at least
``least`` bytes those of the largest page_id are responses and the others revisits that
name it; smaller payloads are all responses.  Every record is a gzip member of its own.
Archives are written by Spark's own file writer, so a lost executor leaves no half archive
behind.

The reader checks every record: gzip member, version line, header fields, lengths, block
digest and closing lines.  Where a check fails it searches for the next place at which a
valid member or record starts, goes on from there and reports the bytes between as a
quarantined gap, so records behind the damage are recovered.  A plain ``.warc``, members
with many records and files of both kinds are read alike.

Null html is an empty payload.  Rows that repeat a page_id and its payload get the same kind of
record; a null page_id is smaller than any other and written as an empty field.  Empty
tables give no archive and no row; columns besides page_id, url and html are not read.
An archive is read whole by one task, so its size is bounded by the writer
(``archive_bytes`` plus one record), and by Spark's two gigabytes for those of others.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.workers import slices
from tidewell.session import scratch_path

ARCHIVE_BYTES = 16 << 20
LEVEL = 1
# Largest block a header may announce: more is taken for damage.
BLOCK_BYTES = 1 << 31

RESPONSE = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"

# Fixed values of the format: the member's first bytes, the version line, and what ends a record.
_MEMBER = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_CLOSING = b"\r\n\r\n"
_FIELD = re.compile(rb"([!#-'*+.0-9A-Z^-z|~-]+):[ \t]*(.*)", re.DOTALL)

RECORDS = (
    "path string, kind string, start long, stop long, inner_start long, inner_stop long, problem string, "
    "record_type string, record_id string, refers_to string, target_uri string, payload_digest string, fields map<string,string>, payload binary"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> bytes:
    """An id that is the same whenever the page is written."""
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{'' if page_id is None else page_id}")).encode()


def _line(text: str) -> bytes:
    """A header value: what would end the line is percent-encoded."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], text.encode("utf-8", "surrogatepass"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record as it stands in an archive that is not compressed."""
    block = REVISIT if revisit else RESPONSE % len(payload) + payload
    fields = [
        (b"WARC-Type", b"revisit" if revisit else b"response"),
        (b"WARC-Record-ID", record_id(page_id)),
        (b"WARC-Date", DATE),
        (b"WARC-Target-URI", _line(url or "")),
        (b"WARC-Page-ID", b"" if page_id is None else b"%d" % page_id),
        (b"WARC-Payload-Digest", b"sha1:" + sha1_base32(payload).encode()),
        (b"WARC-Block-Digest", b"sha1:" + sha1_base32(block).encode()),
        (b"Content-Type", b"application/http; msgtype=response"),
        (b"Content-Length", b"%d" % len(block)),
    ]
    if revisit:
        refers = (b"WARC-Refers-To", record_id(refers_to)), (b"WARC-Refers-To-Page-ID", b"%d" % refers_to)
        fields[4:4] = [*refers, (b"WARC-Profile", PROFILE)]
    return b"WARC/1.1\r\n" + b"".join(b"%s: %s\r\n" % f for f in fields) + b"\r\n" + block + _CLOSING


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is zero.

    A member ends with the high byte of its length, which is zero below 16 MiB; an empty
    member follows a longer one.
    """
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed if packed.endswith(b"\0") else packed + member(b"")


def with_verdicts(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, and the page that a revisit refers to (null: a response)."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    # payloads are compared by digest; only digests are shuffled, and only repeated ones come back
    rows = rows.withColumn("digest", F.when(F.length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    repeated = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    repeated = repeated.where(F.col("n") > 1).drop("n")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("largest")), None).otherwise(F.col("largest"))
    return rows.join(repeated, "digest", "left").select("page_id", "url", "payload", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per page below ``path``, in files of gzip members."""

    def archives(batches):
        held, size = [], 0
        for batch in slices(batches):
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(member(record(page_id, url, payload, refers_to, refers_to is not None)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield whole(held)
                    held, size = [], 0
        if held:
            yield whole(held)

    def whole(members: list[bytes]) -> pa.RecordBatch:
        # the writer ends every row with its separator, here the zero that ends a member
        return pa.record_batch([pa.array([b"".join(members)[:-1]], pa.binary())], ["archive"])

    rows = with_verdicts(pages, least).mapInArrow(archives, "archive binary")
    text = rows.select(F.col("archive").cast("string").alias("value"))
    text.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).option("compression", "none").text(path)


class Damaged(Exception):
    """A check failed."""


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the record that starts at a place, or ``Damaged``."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    head = data.find(_CLOSING, version.end() - 2)
    if head < 0:
        raise Damaged("header without end")
    fields = {}
    for line in data[version.end() : head].split(b"\r\n"):
        found = _FIELD.fullmatch(line)
        if not found:
            raise Damaged("header field")
        name = found[1].decode("ascii").lower()
        # only one field may repeat; others do where a header cut short runs into the next
        if name in fields and name != "warc-concurrent-to":
            raise Damaged("repeated header field")
        fields[name] = found[2].decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,10}", length) or int(length) > BLOCK_BYTES:
        raise Damaged("content length")
    start = head + len(_CLOSING)
    stop = start + int(length)
    if stop + len(_CLOSING) > len(data):
        raise Damaged("record cut short")
    if data[stop : stop + len(_CLOSING)] != _CLOSING:
        raise Damaged("record without closing lines")
    block = data[start:stop]
    said = fields.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:].upper() != sha1_base32(block):
        raise Damaged("block digest")
    return fields, block, stop + len(_CLOSING)


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at a place, or ``Damaged``."""
    unpacker, view, parts = zlib.decompressobj(31), memoryview(data), []
    # most false starts end within the first few bytes
    step = 4096
    while not unpacker.eof:
        if at >= len(data):
            raise Damaged("gzip member cut short")
        try:
            parts.append(unpacker.decompress(view[at : at + step]))
        except zlib.error:
            raise Damaged("gzip member") from None
        at, step = at + len(view[at : at + step]), 65536
        if parts[0] and not parts[0].startswith(b"WARC/"[: len(parts[0])]):
            raise Damaged("member holds no record")
    return b"".join(parts), at - len(unpacker.unused_data)


def salvage(data: bytes, inside: bool = False) -> Iterator[tuple]:
    """(start, stop, inner_start, inner_stop, problem, fields, block) of every record and gap.

    A gap has a problem and no fields.  ``inner_*`` are places within the content of a member.
    """
    at, gap, problem = 0, None, None

    def valid(at: int) -> tuple[list, int]:
        if not inside and data.startswith(_MEMBER, at):
            content, stop = inflate(data, at)
            if not content:
                return [], stop
            found = list(salvage(content, True))
            if all(f[4] for f in found):
                raise Damaged(found[0][4])
            return [(at, stop, *f[:2], *f[4:]) for f in found], stop
        fields, block, stop = parse(data, at)
        return [(at, stop, None, None, None, fields, block)], stop

    while at < len(data):
        try:
            found, stop = valid(at)
        except Damaged as failed:
            if gap is None:
                gap, problem = at, str(failed)
            following = (_VERSION if inside else _START).search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, None, problem, None, None
            gap = None
        yield from found
        at = stop
    if gap is not None:
        yield gap, len(data), None, None, problem, None, None


def payload_of(fields: dict[str, str], block: bytes) -> bytes | None:
    """Body of an HTTP response; the block of other records; nothing for a revisit."""
    if fields.get("warc-type") == "revisit":
        return None
    if not fields.get("content-type", "").startswith("application/http"):
        return block
    head = block.find(_CLOSING)
    return block[head + len(_CLOSING) :] if head >= 0 else b""


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record (``kind`` record) and quarantined gap (``kind`` gap) of the files below ``path``.

    A record whose payload differs from its payload digest is kept with that as its problem.
    """

    def rows(path, data):
        for start, stop, inner_start, inner_stop, problem, fields, block in salvage(data):
            if fields is None:
                yield path, "gap", start, stop, inner_start, inner_stop, problem, None, None, None, None, None, None, None
                continue
            payload = payload_of(fields, block)
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            if payload is not None:
                true = sha1_base32(payload)
                problem = "payload digest" if digest not in (None, true) else None
                digest = true
            names = "warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri"
            kept = [fields.get(n) for n in names]
            yield path, "record", start, stop, inner_start, inner_stop, problem, *kept, digest, list(fields.items()), payload

    def read(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                held, size = [], 0
                for row in rows(batch.column(0)[n].as_py(), batch.column(1)[n].as_py()):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size > ARCHIVE_BYTES or len(held) == 512:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], NAMES)
                        held, size = [], 0
                if held:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), KINDS)], NAMES)

    text, place = pa.string(), pa.int64()
    KINDS = [text, text, place, place, place, place, text, text, text, text, text, text, pa.map_(text, text), pa.binary()]
    NAMES = [c.split()[0] for c in RECORDS.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, RECORDS)


def pages_read(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page record.

    The payload of a revisit is the one of the record that it refers to.
    """
    records = found.where(F.col("kind") == "record")
    page = [F.col("fields")[n].try_cast("long").alias(c) for n, c in (("warc-page-id", "page_id"), ("warc-refers-to-page-id", "refers_to"))]
    rows = records.select(*page, F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "record_id", F.col("refers_to").alias("original"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = rows.where(F.col("record_type") == "response")
    # an original may be written more than once; only what is referred to meets its revisits
    lengths = responses.groupBy(F.col("record_id").alias("original"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = rows.where(F.col("record_type") == "revisit").drop("payload_bytes").join(lengths, ["original", "payload_digest"], "left")
    return responses.select(columns).unionByName(revisits.select(columns))


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the archives of all pages to the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    return pages_read(read_archives(pages.sparkSession, path))


ORACLE_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as hex,
       max(page_id) over (partition by coalesce(html, '')) as largest from pages)
select page_id, octet_length(payload) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (cast('0x' || substr(hex, 1 + 5 * cast(floor(k / 4) as int), 5) as int) >> (15 - 5 * (k % 4))) % 32, 1)), '') as payload_digest,
       case when page_id is not distinct from largest then 'response' else 'revisit' end as record_type,
       case when page_id is not distinct from largest then null else largest end as refers_to
from p
"""
