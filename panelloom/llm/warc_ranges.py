"""WARC archives: a writer with revisit records and a reader that splits files anywhere.

Writing. Rows with equal payloads meet by their SHA-256: only digests that occur more than once
go to a small table, which the rows are joined with. A record is one gzip member. The row with
the smallest id is a ``response``, the others are ``revisit`` records that refer to it and carry no
payload; both state the digest and the length of the full payload. Tasks write archives of about
``archive_bytes`` under names of their own into the shared folder; the list of files is itself a
written table, so a file of a task that was lost or run twice is not in it.

Reading. Files are cut into byte ranges, one row each, dealt to tasks. A task scans its range for
the gzip magic, takes a candidate as a member if it decodes to a WARC header and to its end
(checksum and all), and owns the records that start inside its range, reading past its end for
the last. From a record's end it goes on without scanning. A range may begin inside a record
whose payload holds whole members (an archive in an archive): records that start before the end
of a record of an earlier range are dropped, which a small table of the ranges tells.

Defined results: null payloads are empty; the empty payload is a payload like any other.
Null ids sort after all others; if all rows of a payload have null ids, all are responses. Rows
that share the smallest id are all responses. A null url writes no target; in urls, bytes outside
printable ASCII are percent-encoded. Long payloads are one record each and held in memory
once. Bytes between members that are no member are skipped; a damaged record is, too, and counts
as such bytes; a payload that does not fit its stated digest raises. Empty tables give an archive
list without rows, and no records. Columns not named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import keep, release
from panelloom.session import scratch_path

ARCHIVE_BYTES = 1 << 30
RANGE_BYTES = 1 << 20
READ_BYTES = 1 << 18
BATCH_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = "tag:panelloom,2026:record/"
FILES = "path STRING, size BIGINT, n_records BIGINT"
RECORDS = (
    "id STRING, url STRING, record_type STRING, payload_bytes BIGINT, payload_digest STRING, "
    "refers_to STRING, payload BINARY, path STRING, range BIGINT, offset BIGINT, next BIGINT"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(row_id: str | None) -> str:
    """Record name of an id; a null id has a name that no id has."""
    return f"<{NAMES}{'null' if row_id is None else 'id/' + quote(row_id, safe='')}>"


def _id_of(name: str) -> str | None:
    """The id that a record name holds; a name from elsewhere is an id itself."""
    name = name.removeprefix("<").removesuffix(">")
    if not name.startswith(NAMES):
        return name or None
    kind, _, row_id = name.removeprefix(NAMES).partition("/")
    return unquote(row_id) if kind == "id" else None


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = b"".join(
        [VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in fields),
         f"Content-Length: {len(block)}\r\n\r\n".encode()]
    )
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([packer.compress(head), packer.compress(block), packer.compress(b"\r\n\r\n"),
                     packer.flush()])


def record(
    row_id: str | None, url: str | None, payload: bytes, refers_to: tuple[str | None] | None
) -> bytes:
    """A response, or a revisit of the record named by ``refers_to`` (an id in a tuple)."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", _name(row_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if url is not None:
        fields.append(
            ("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
        )
    if refers_to:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _name(refers_to[0]))]
    return _member(fields, http if refers_to else http + payload)


def _info() -> bytes:
    """The record that opens an archive."""
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
         ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
        b"format: WARC File Format 1.1\r\n",
    )


def write_archives(
    spark: SparkSession,
    rows: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    folder: str | None = None,
    least_revisit: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per row; returns the archives: ``path``, ``size``, ``n_records``.

    Payloads of fewer than ``least_revisit`` bytes are always responses.
    """
    plain = rows.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_payload"),
    )
    keyed = plain.withColumn("_key", F.sha2("_payload", 256))
    # A row per task and digest is all that a frequent payload sends here.
    firsts = (
        keyed.where(F.length("_payload") >= least_revisit).groupBy("_key")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1 and _first is not null").select("_key", "_first")
    )
    # Written first, so that the join has a shuffle of its own, which can be split where hot.
    shared = keep(spark, firsts, "shared-payloads")
    decided = keyed.join(shared, "_key", "left").select(
        F.col("_id").cast("string").alias("_id"), F.col("_url").cast("string").alias("_url"),
        "_payload", F.col("_first").cast("string").alias("_first"),
        (F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))).alias("_again"),
    )
    target = folder or scratch_path(spark, "archives")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pa.fs.FileSystem.from_uri(uri)
        files.create_dir(base, recursive=True)
        name, out, size, count = "", None, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            values = [[f"{uri}/{name}"], [size], [count]]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["path", "size", "n_records"])

        for batch in batches:
            for i in range(batch.num_rows):
                row_id, url, payload, first, again = (c[i].as_py() for c in batch.columns)
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    data = _info()
                    out.write(data)
                    size, count = len(data), 0
                data = record(row_id, url, payload, (first,) if again else None)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
        release()

    return keep(spark, decided.mapInArrow(write, FILES), "archive-list")


class Stretch:
    """A file read forward and by jumps, holding one stretch of it."""

    def __init__(self, file: pa.NativeFile, size: int) -> None:
        self.file, self.size = file, size
        self.begin, self.data = 0, b""

    def at(self, offset: int, count: int) -> bytes:
        """Up to ``count`` bytes from ``offset``."""
        count = max(0, min(count, self.size - offset))
        low = offset - self.begin
        if low < 0 or low + count > len(self.data):
            self.file.seek(offset)
            self.data = self.file.read(min(max(count, READ_BYTES), self.size - offset))
            self.begin, low = offset, 0
        return self.data[low : low + count]


def inflate(window: Stretch, offset: int) -> tuple[bytes, int] | None:
    """The member that starts at ``offset`` and where it ends; None if there is no WARC record."""
    step = 4096
    data = window.at(offset, step)
    if data[:3] != MAGIC or len(data) < 18 or data[3] & 0xE0:
        return None
    unpacker, parts, at, checked = zlib.decompressobj(31), [], offset, False
    try:
        while data:
            parts.append(unpacker.decompress(data))
            at += len(data)
            if not checked and sum(map(len, parts)) >= 5:
                parts, checked = [b"".join(parts)], True
                if not parts[0].startswith(b"WARC/"):
                    return None
            if unpacker.eof:
                return (b"".join(parts), at - len(unpacker.unused_data)) if checked else None
            step = min(step * 4, READ_BYTES)
            data = window.at(at, step)
    except zlib.error:
        pass
    return None


def members(window: Stretch, begin: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """Offset, end and bytes of every record that starts from ``begin`` to before ``end``."""
    at = begin
    while at < end:
        found = inflate(window, at)
        if found is None:
            # Scan on for the magic; it may reach over the end of the range.
            at += 1
            while at < end:
                data = window.at(at, min(READ_BYTES, end - at + len(MAGIC) - 1))
                hit = data.find(MAGIC)
                if hit >= 0:
                    at += hit
                    break
                at += max(1, len(data) - len(MAGIC) + 1)
            continue
        yield at, found[1], found[0]
        at = found[1]


def _fields(head: bytes) -> dict[str, str]:
    lines = re.split(rb"\r\n", head)[1:]
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {key.strip().lower(): value.strip() for key, _, value in pairs}


def parse(data: bytes) -> dict:
    """Fields of a record and its payload (none for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields.get("content-length", 0))]
    kind = fields.get("warc-type", "")
    out = {
        "id": _id_of(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri"),
        "record_type": kind, "payload_bytes": len(block), "payload": block,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": None,
    }
    if "msgtype=response" in fields.get("content-type", ""):
        http, _, payload = block.partition(b"\r\n\r\n")
        out["payload"], out["payload_bytes"] = payload, len(payload)
        if kind == "revisit":
            out["payload"] = None
            out["payload_bytes"] = int(_fields(http).get("content-length", 0))
            out["refers_to"] = _id_of(fields.get("warc-refers-to", ""))
        elif out["payload_digest"] not in (None, digest(payload)):
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not fit its digest")
    return out


def read_archives(
    spark: SparkSession,
    files: DataFrame,
    range_bytes: int = RANGE_BYTES,
    payloads: bool = True,
) -> DataFrame:
    """All records of the archives in ``files`` (``path``, ``size``), ``warcinfo`` included.

    ``payloads=False`` leaves ``payload`` null; digests and lengths are still of the whole
    payload. ``id`` and ``refers_to`` are ids as text.
    """
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / range_bytes) - 1)
    ranges = files.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("range")
    )
    # Neighbouring ranges go to different tasks; a large file is read by many.
    cores = spark.sparkContext.defaultParallelism
    ranges = ranges.repartition(4 * cores, "path", "range")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to",
                 "payload", "path", "range", "offset", "next"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
                 pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        held: list[tuple] = []
        room = BATCH_BYTES

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) if held else [()] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for row in batch.to_pylist():
                system, name = pa.fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(name) as file:
                    window = Stretch(file, row["size"])
                    begin = row["range"] * range_bytes
                    end = min(begin + range_bytes, row["size"])
                    for offset, after, data in members(window, begin, end):
                        found = parse(data)
                        if not payloads:
                            found["payload"] = None
                        held.append((*(found[n] for n in names[:7]), row["path"], row["range"],
                                     offset, after))
                        room -= len(found["payload"] or b"") + 200
                        if room <= 0:
                            yield batch_of()
                            held, room = [], BATCH_BYTES
        if held:
            yield batch_of()
        release()

    found = keep(spark, ranges.mapInArrow(read, RECORDS), "records")
    per_range = found.groupBy("path", "range").agg(
        F.min("offset").alias("_low"), F.max("next").alias("_high")
    )
    return _owned(spark, found, per_range)


def _owned(spark: SparkSession, found: DataFrame, per_range: DataFrame) -> DataFrame:
    """Records that don't lie inside a record of an earlier range."""
    before = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = per_range.withColumn("_from", F.max("_high").over(before)).where("_low < _from")
    wrong = keep(spark, inside.select("path", "range", "_from"), "nested-ranges")
    marked = found.join(wrong, ["path", "range"], "left")
    return marked.where("_from is null or offset >= _from").drop("_from", "range")
