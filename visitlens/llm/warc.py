"""Write pages as WARC archives and read archives back, damaged ones too.

Writing: every record is a gzip member of its own. Pages with equal payloads of
``LEAST_REVISIT`` bytes or more share one response, that of the smallest page
id; the others become revisit records that name it. The archives are written by
Spark's text writer, one member a row, so a lost executor's files are never half
there; an empty gzip member is the separator between rows, which every gzip
reader skips.

Reading: the archives' records are taken one after the other, compressed or
plain. When a record fails a check (checksum of the member, version line, header,
length, digest), the reader searches for the next valid member or version line,
goes on there and reports the bytes between as a gap. A member may hold many records:
those before and after a damaged one are kept, and so are those whose payloads match
their digests in a member that is cut off or fails its checksum. Files are read whole;
``RECORDS_PER_FILE`` bounds those that are written here.

Cases: a null html is an empty payload. A null page id or url leaves its header
out. Rows that repeat the smallest page id of a payload are all responses. An
empty table gives no archive and no records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.scratch import save, shared_folder

LEAST_REVISIT = 100
RECORDS_PER_FILE = 20_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# An empty member: header, empty deflate block, checksum 0, size 0.
SEPARATOR = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
_MAGIC = b"\x1f\x8b\x08"
# A record cut off in its middle leaves the next version line inside a line.
_VERSION = re.compile(rb"WARC/1\.[0-9]\r\n")
_CANDIDATE = re.compile(rb"\x1f\x8b\x08|" + _VERSION.pattern)
_STEP = 1 << 16

RECORD_FIELDS = (
    "file string, start long, end long, gap string, page_id long, url string, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


# ---- writing ---------------------------------------------------------------


def archive_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One WARC/1.1 record, a response or a revisit of ``refers_to``."""
    block = HTTP if refers_to is not None else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}",
            f"X-Payload-Length: {len(payload)}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest",
                                                      "refers_to"))
        out = [_member(archive_record(*row)) for row in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def with_first_copy(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) for each row of ``pages``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    # only payloads that occur twice; counted before the shuffle
    first = save(
        plain.where(F.octet_length("payload") >= LEAST_REVISIT)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "first")
    )
    other = F.col("first") != F.col("page_id")
    return plain.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.coalesce(other, F.lit(False)), F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write ``pages`` (page_id, url, html) as gzip archives below ``folder``."""
    members = with_first_copy(pages).mapInArrow(_members, "member binary")
    (
        members.select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


# ---- reading ---------------------------------------------------------------


class Damaged(ValueError):
    """A record that fails a check."""


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at ``at`` and its end."""
    if not _VERSION.match(data, at):
        raise Damaged("version")
    middle = data.find(b"\r\n\r\n", at)
    if middle < 0:
        raise Damaged("header")
    head = {}
    for line in data[at:middle].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        raise Damaged("header")
    begin = middle + 4
    end = begin + int(head["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("length")
    block = data[begin:end]
    body = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    revisit = head.get("warc-type") == "revisit"
    checked = False
    digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
    if not revisit:
        actual = hashlib.sha256(body).hexdigest()
        if len(digest) == 64 and digest != actual:
            raise Damaged("digest")
        checked = len(digest) == 64
        digest = actual
    length = head.get("x-payload-length", "") if revisit else str(len(body))

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", head.get(name, ""))
        return int(found[1]) if found else None

    return {
        "page_id": page("warc-record-id"), "url": head.get("warc-target-uri"),
        "record_type": head.get("warc-type"), "refers_to": page("warc-refers-to"),
        "payload_bytes": int(length) if re.fullmatch("[0-9]{1,18}", length) else None,
        "payload_digest": digest, "payload": None if revisit else body, "checked": checked,
    }, end + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Content of the gzip member at ``at``, its end, and what damage ends it early."""
    unpack = zlib.decompressobj(31)
    parts, fed = [], at
    try:
        while not unpack.eof and fed < len(data):
            piece = data[fed : fed + _STEP]
            parts.append(unpack.decompress(piece))
            fed += len(piece)
    except zlib.error:
        rest, end = _upto_damage(data, at, fed)
        return b"".join([*parts, rest]), end, "member"
    return b"".join(parts), fed - len(unpack.unused_data), None if unpack.eof else "truncated"


def _upto_damage(data: bytes, at: int, fed: int) -> tuple[bytes, int]:
    """What the member at ``at`` gives from ``fed`` on before the byte that fails, and
    that byte's place."""
    unpack = zlib.decompressobj(31)
    for place in range(at, fed, _STEP):
        unpack.decompress(data[place : min(fed, place + _STEP)])
    parts: list[bytes] = []
    for place in range(fed, len(data)):
        try:
            parts.append(unpack.decompress(data[place : place + 1]))
        except zlib.error:
            return b"".join(parts), place
    return b"".join(parts), len(data)


def _within(content: bytes, whole: bool) -> list[dict | str]:
    """Records of a member's content and the reasons of gaps between them, in order.

    Without the member's checksum only payloads that match their digest count.
    """
    found: list[dict | str] = []
    at, reason = 0, None
    while at < len(content):
        try:
            record, end = _parse(content, at)
            if not (whole or record.pop("checked")):
                raise Damaged("member")
        except Damaged as damage:
            reason = reason or str(damage)
            after = _VERSION.search(content, at + 1)
            at = after.start() if after else len(content)
            continue
        if reason is not None:
            found.append(reason)
            reason = None
        record.pop("checked", None)
        found.append(record)
        at = end
    return found if reason is None else [*found, reason]


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record or reason of a gap) over all bytes of an archive.

    Records and gaps inside a member have the member's place. A damaged member is a
    gap, and the records that it gave before the damage come before that gap.
    """
    at, lost, reason = 0, None, ""
    given: list[dict] = []  # by damaged members of the open gap
    while at < len(data):
        try:
            if data.startswith(_MAGIC, at):
                content, end, damage = _inflate(data, at)
                found = _within(content, damage is None)
                if damage is not None:
                    for record in found:
                        if isinstance(record, dict) and record not in given:
                            given.append(record)
                            yield at, end, record
                    raise Damaged(damage)
            else:
                record, end = _parse(data, at)
                record.pop("checked")
                found = [record]
        except Damaged as damage:
            if lost is None:
                lost, reason = at, str(damage)
            after = _CANDIDATE.search(data, at + 1)
            at = after.start() if after else len(data)
            continue
        if found and not any(isinstance(f, dict) for f in found):
            if lost is None:
                lost, reason = at, str(found[0])
            at = end
            continue
        if given and len(found) == 1 and found[0] in given:  # stored in it uncompressed
            at = end
            continue
        if lost is not None:
            yield lost, at, reason
            lost, given = None, []
        for record in found:
            yield at, end, record
        at = end
    if lost is not None:
        yield lost, len(data), reason


_NAMES = [f.split()[0] for f in RECORD_FIELDS.split(", ")]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        (n, pa.binary() if n == "payload" else pa.int64()
         if n in ("start", "end", "page_id", "refers_to", "payload_bytes") else pa.string())
        for n in _NAMES
    ])
    for batch in batches:
        for path, content in zip(
            batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True
        ):
            rows, held = [], 0
            for start, end, found in salvage(content):
                row = {"file": path, "start": start, "end": end}
                row |= {"gap": found} if isinstance(found, str) else found
                rows.append(row)
                held += len(row.get("payload") or b"")
                if held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records and gaps of all files of a folder (see ``RECORD_FIELDS``).

    A gap has its reason in ``gap`` and nulls in the record's columns.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_read, RECORD_FIELDS)


def records(read: DataFrame) -> DataFrame:
    return read.where(F.col("gap").isNull()).drop("gap")


def quarantined(read: DataFrame) -> DataFrame:
    """(file, start, end, reason) of the bytes that hold no valid record."""
    return read.where(F.col("gap").isNotNull()).select(
        "file", "start", "end", F.col("gap").alias("reason")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to the shared folder and what is read back from there."""
    folder = shared_folder(pages.sparkSession)
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
