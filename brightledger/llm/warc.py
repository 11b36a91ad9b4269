"""Web archives (WARC): a writer that leaves repeated payloads out, and a reader that salvages.

The reader checks every record: its member inflates and its checksum is right, the version line
and headers are there, the block has its stated length and end, and the digests agree. After a
failed check it searches on from the next byte for a place where a valid member or version line
begins, goes on from there and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightledger.llm.common import fresh_folder, stored
from brightledger.llm.files import NewFile, opened

ARCHIVE_BYTES = 256 << 20  # of an archive, as written
BATCH_BYTES = 4 << 20  # of payloads that the reader hands on together
WINDOW_BYTES = 1 << 20  # read ahead
FEED_BYTES = 1 << 16  # inflated at a time
MOST_HEADERS = 1 << 16  # bytes of a record's headers
READERS = 100_000  # tasks that read archives, at most

# Fixed values of the format.
VERSION = b"WARC/1.1"
LINE, END = b"\r\n", b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
_VERSION_LINE = re.compile(rb"WARC/\d\.\d\r\n")

ENTRY = (
    "archive string, offset long, length long, kind string, reason string, record_type string, record_id string, "
    "uri string, refers_to string, payload binary, payload_bytes long, payload_digest string"
)
_NAMES = [part.strip().split()[0] for part in ENTRY.split(",")]


def bare_digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{bare_digest(block)}"), ("Content-Length", str(len(block)))]
    head = LINE.join([VERSION, *[f"{name}: {value}".encode() for name, value in lines if value is not None]])
    return head + END + block + END


def member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


# ---------------------------------------------------------------- reading


class Damage(Exception):
    """A check that failed."""


@dataclass
class Entry:
    offset: int
    length: int
    kind: str  # record or gap
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)  # by lower-case name
    payload: bytes | None = None
    payload_bytes: int | None = None


class Window:
    """Bytes of an open file from any place, read ahead in one piece."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.base, self.held = 0, b""

    def get(self, at: int, count: int) -> bytes:
        count = max(0, min(count, self.size - at))
        if at < self.base or at + count > self.base + len(self.held):
            self.file.seek(at)
            self.base, self.held = at, self.file.read(max(count, WINDOW_BYTES))
        return self.held[at - self.base : at - self.base + count]


def entries(file, size: int) -> Iterator[Entry]:
    """All records of an archive, of gzip members or plain, and the gaps between them, in order.

    The entries cover every byte once. A member that holds several records gives one entry for
    each, all at its place.
    """
    window, at, bad, reason = Window(file, size), 0, None, None
    while at < size:
        try:
            found, end = _at(window, at)
        except Damage as failed:
            if bad is None:
                bad, reason = at, str(failed)
            at = _next_begin(window, at + 1)
            continue
        if bad is not None:
            yield Entry(bad, at - bad, "gap", reason)
            bad = None
        for entry in found:
            entry.offset, entry.length = at, end - at
            yield entry
        at = end
    if bad is not None:
        yield Entry(bad, size - bad, "gap", reason)


def _next_begin(window: Window, at: int) -> int:
    """The next place where a member or a version line may begin, or the end of the file."""
    while at < window.size:
        part = window.get(at, FEED_BYTES)
        found = _BEGIN.search(part)
        if found:
            return at + found.start()
        if at + len(part) >= window.size:
            break
        at += len(part) - 16  # a beginning may lie across the border
    return window.size


def _at(window: Window, at: int) -> tuple[list[Entry], int]:
    """The records that begin at a place, and where they end."""
    begin = window.get(at, 10)
    if begin.startswith(MEMBER):
        return _of_member(window, at)
    if begin.startswith(b"WARC/"):
        return _plain(window, at)
    raise Damage("no member or version line")


def _of_member(window: Window, at: int) -> tuple[list[Entry], int]:
    inflate, parts, place, begun = zlib.decompressobj(31), [], at, b""
    try:
        while not inflate.eof:
            fed = window.get(place, FEED_BYTES)
            if not fed:
                raise Damage("member ends early")
            parts.append(inflate.decompress(fed))
            place += len(fed)
            if len(begun) < 5:
                begun += parts[-1][:5]
                if not b"WARC/".startswith(begun[:5]):
                    raise Damage("member holds no record")
    except zlib.error:
        raise Damage("member does not inflate") from None
    data, end = b"".join(parts), place - len(inflate.unused_data)
    found, done = [], 0
    while done < len(data):
        entry, done = _parsed(data, done)
        found.append(entry)
    if not found:
        raise Damage("member holds no record")
    return found, end


def _plain(window: Window, at: int) -> tuple[list[Entry], int]:
    head = window.get(at, MOST_HEADERS)
    length = _stated_length(head, 0)
    size = head.index(END) + len(END) + length + len(END)
    data = window.get(at, size)
    entry, end = _parsed(data, 0)
    return [entry], at + end


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    if not _VERSION_LINE.match(data, at):
        raise Damage("no version line")
    end = data.find(END, at, at + MOST_HEADERS)
    if end < 0:
        raise Damage("headers do not end")
    headers: dict[str, str] = {}
    name = None
    for line in data[at:end].split(LINE)[1:]:
        if line[:1] in (b" ", b"\t") and name:  # a folded line
            headers[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        before, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header without a name")
        name = before.strip().decode("utf-8", "replace").lower()
        headers[name] = value.strip().decode("utf-8", "replace")
    return headers, end + len(END)


def _stated_length(data: bytes, at: int) -> int:
    stated = _headers(data, at)[0].get("content-length", "")
    if not (stated.isascii() and stated.isdigit()):
        raise Damage("no length")
    return int(stated)


def _parsed(data: bytes, at: int) -> tuple[Entry, int]:
    """The record at a place of inflated or plain bytes, and where it ends."""
    headers, begin = _headers(data, at)
    if not headers.get("warc-type") or not headers.get("warc-record-id"):
        raise Damage("no type or id")
    end = begin + _stated_length(data, at)
    if data[end : end + len(END)] != END:
        raise Damage("block has another length")
    block = data[begin:end]
    _check_digest(headers.get("warc-block-digest"), block, "block")
    payload = payload_bytes = None
    http = headers.get("content-type", "").lower().startswith("application/http")
    head, cut, rest = block.partition(END) if http else (b"", b"", block)
    kind = headers["warc-type"].lower()
    if kind == "revisit":
        # The block has the headers of the answer, whose length is that of the whole payload.
        stated = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", head)
        payload_bytes = int(stated[1]) if stated else None
    elif kind != "warcinfo":
        if http and not cut:
            raise Damage("answer without a body")
        payload, payload_bytes = rest, len(rest)
        _check_digest(headers.get("warc-payload-digest"), payload, "payload")
    return Entry(0, 0, "record", None, headers, payload, payload_bytes), end + len(END)


def _check_digest(stated: str | None, data: bytes, what: str) -> None:
    """Digests in base32 or hex; one of an unknown kind is not checked."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() in ("sha1", "md5", "sha256"):
        made = hashlib.new(kind.lower(), data).digest()
        if value.rstrip("=").upper() != base64.b32encode(made).decode().rstrip("=") and value.lower() != made.hex():
            raise Damage(f"{what} digest differs")


def _row(archive: str, entry: Entry) -> tuple:
    of = entry.headers.get
    digest = (of("warc-payload-digest") or "").removeprefix("sha1:") or None
    return (
        archive, entry.offset, entry.length, entry.kind, entry.reason, (of("warc-type") or "").lower() or None, of("warc-record-id"),
        of("warc-target-uri"), of("warc-refers-to"), entry.payload, entry.payload_bytes, digest,
    )


def read_archives(archives: DataFrame, readers: int = READERS) -> DataFrame:
    """One row per record and per gap of every archive, whose full path is in column ``path``.

    ``archive``, ``offset`` and ``length`` say where an entry lies and ``kind`` whether it is a
    ``record`` or a ``gap``; a gap has the ``reason`` of its first failed check and nothing
    else. A record has its ``record_type``, ``record_id``, ``uri``, ``refers_to`` (null if it
    states none), ``payload`` (null for a revisit or warcinfo), ``payload_bytes`` (of a revisit
    as its headers state it) and ``payload_digest`` (without ``sha1:``).

    An archive is read by one task, in order, with memory for one record, or one member of
    several; archives share ``readers`` tasks at most. Empty archives and an empty table give
    no rows, a null path none; a path that comes twice is read twice; other columns are ignored. Bytes that are no
    record at all are one gap. Records without digests are taken by their lengths alone, and
    a valid record that lies inside the bytes of a damaged one is read as one of the archive.
    """
    paths = archives.select("path").where("path IS NOT NULL")
    types = [pa.string() if "string" in p else pa.binary() if "binary" in p else pa.int64() for p in ENTRY.split(",")]
    schema = pa.schema(list(zip(_NAMES, types)))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], schema=schema)

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, place = opened(path)
                with files.open_input_file(place) as file:
                    rows, held = [], 0
                    for entry in entries(file, file.size()):
                        rows.append(_row(path, entry))
                        held += 1024 + len(entry.payload or b"")
                        if held >= BATCH_BYTES:
                            yield packed(rows)
                            rows, held = [], 0
                    if rows:
                        yield packed(rows)

    tasks = max(1, min(paths.count(), readers))
    return paths.repartition(tasks).mapInArrow(read, ENTRY)


# ---------------------------------------------------------------- writing


@dataclass(frozen=True)
class Archives:
    spark: SparkSession
    folder: str

    def paths(self) -> DataFrame:
        """The archives that were written whole: path, records, bytes."""
        return self.spark.read.parquet(f"{self.folder}/written")

    def entries(self) -> DataFrame:
        return read_archives(self.paths())


def write_archives(
    pages: DataFrame, key: str, uri: str, body: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, compressed: bool = True
) -> Archives:
    """Writes a record per row of ``pages``: a ``response`` with the UTF-8 bytes of ``body`` as
    payload, or a ``revisit`` of the response with an equal payload.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the smallest key is
    the response (nulls last; of equal keys the one with the smallest uri, of equal rows any
    one) and the others revisit it; rows with smaller payloads are responses each. A null body
    is empty. The id of a record is its key (``record_id`` turns it back), so rows that repeat
    a key share it. A null uri has no header; its control signs and blanks are percent-encoded.
    Other columns are ignored; an empty table gives no archive. Payloads are told apart by
    SHA-1 and length.

    A response is gathered by digest, each payload once per task that read it, so a payload of a
    third of all rows is sent a few times; revisits travel without payload, and the rows of a
    hot payload are split where they are joined with its response's key. A task streams its
    records to archives of ``archive_bytes`` in members of one record; only archives in the
    table of a task that ended count, so a lost executor's half archives are never read.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.select(F.struct(F.col("key").isNull().alias("last"), "key", "uri").alias("row"), "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    small, large = rows.where(F.col("bytes") < least_bytes), rows.where(F.col("bytes") >= least_bytes)

    firsts = large.groupBy("digest", "bytes").agg(F.min("row").alias("row"), F.first("payload").alias("payload"))
    responses = firsts.unionByName(small).select("row.key", "row.uri", "digest", "bytes", "payload", F.lit(None).cast("string").alias("refers_to"))

    # Without payloads: every row but the response's own, as often as it is there.
    known = stored(large.groupBy("digest", "bytes").agg(F.min("row").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows"), "warc-firsts")
    counted = large.groupBy("digest", "bytes", "row").agg(F.count("*").alias("copies"))
    again = counted.join(known, ["digest", "bytes"]).withColumn("copies", F.col("copies") - F.col("row").eqNullSafe(F.col("first")).cast("int"))
    again = again.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    revisits = again.select(
        "row.key", "row.uri", "digest", "bytes", F.lit(None).cast("binary").alias("payload"), record_id(F.col("first.key")).alias("refers_to")
    )
    made = responses.unionByName(revisits).withColumn("id", record_id(F.col("key")))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    ending = "warc.gz" if compressed else "warc"

    def written(row: dict) -> bytes:
        digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
        again = row["refers_to"] is not None
        address = row["uri"] and re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["uri"])
        headers = [
            ("WARC-Type", "revisit" if again else "response"),
            ("WARC-Record-ID", row["id"]),
            ("WARC-Date", date),
            ("WARC-Target-URI", address),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Refers-To", row["refers_to"]),
            ("WARC-Profile", SAME_PAYLOAD if again else None),
            ("Content-Type", "application/http; msgtype=response"),
        ]
        answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
        return record(headers, answer + (b"" if again else row["payload"]))

    def information(name: str) -> bytes:
        headers = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"),
            ("WARC-Date", date),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ]
        return record(headers, b"format: WARC File Format 1.1\r\n")

    def write(batches):
        as_written = member if compressed else bytes
        name = file = None
        records = size = 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                if file is None:
                    name, records = f"{uuid4().hex}.{ending}", 0
                    file = NewFile(folder, name)
                    size = file.out.write(as_written(information(name)))
                size += file.out.write(as_written(written(row)))
                records += 1
                if size >= archive_bytes:
                    file.close()
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})
                    file = None
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

    made.mapInArrow(write, "path string, records long, bytes long").write.parquet(f"{folder}/written")
    return Archives(spark, folder)


def record_id(key):
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def key_of(record_id):
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")
