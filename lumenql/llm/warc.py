"""WARC archives: writing segmented, chunked records, and reassembling them.

A payload is framed by chunked transfer coding behind an HTTP header. A record longer
than ``segment_bytes`` is cut into a first segment and continuation records, which name
the first by ``WARC-Segment-Origin-ID`` and carry their number; the last one states the
total length. Readers group continuations by origin, order them by number, verify the
total, and only then decode the chunks. Equal payloads of at least ``revisit_bytes``
are stored once: the record with the largest page id keeps the payload, the others are
revisits with the digest and length of the full payload.

Files go through Spark's text writer, so they reach whatever store holds the path and
appear by its commit protocol. Each record is a gzip member of its own. A member of less
than 16 MB ends in a zero byte, which is the writer's line separator; so a file is a
sequence of members and nothing else, as in any compressed WARC file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import hadoop
from .common import in_groups, materialize, scratch, text_key

#: Bytes of a record's block, of a chunk, and of a file with its records' heads before compression.
SEGMENT_BYTES, CHUNK_BYTES, FILE_BYTES = 1 << 16, 1 << 13, 1 << 26
#: Bytes of a record's head, more than usual ones have.
HEAD_BYTES = 1 << 10
#: Bytes above which a batch goes to Spark. Its heap grows by large arrays and does not shrink again.
BATCH_BYTES = 1 << 21
REVISIT_BYTES = 1000
#: Leading bits of a digest's hash that have a place in the bitmap of repeated payloads.
BITMAP_BITS = 26
#: Names of archive files in a folder; this writer's own end in ``.txt``.
FILE_NAMES = "*.{txt,warc,gz}"
END = b"\r\n\r\n"
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:lumenql:warc")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _cuts(data: bytes, size: int):
    return (data[at : at + size] for at in range(0, len(data), size))


def frame(payload: bytes) -> bytes:
    """Chunked transfer coding of a payload."""
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cuts(payload, CHUNK_BYTES)) + b"0\r\n\r\n"


def unframe(body: bytes) -> bytes:
    """The payload of a chunked body; trailers are passed over, damage raises ``ValueError``."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where it says")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + END


def records(page_id, uri, payload: bytes, digest: str, refers_to, name: str, segment_bytes: int = SEGMENT_BYTES):
    """The records of one page, each with its two closing line ends."""
    own = lambda k: f"<urn:uuid:{uuid.uuid5(_IDS, f'{name}/{k}')}>"
    uri = None if uri is None else "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in uri)
    common = [("WARC-Target-URI", uri), ("WARC-Date", "2026-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page_id)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own(1)), *common, kind, ("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", refers_to)]
        yield _record(fields, http + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + frame(payload)
    parts = list(_cuts(block, segment_bytes))
    for k, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if k == 1 else "continuation"), ("WARC-Record-ID", own(k))]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", k))
        if k > 1:
            fields.append(("WARC-Segment-Origin-ID", own(1)))
        if k == len(parts) > 1:
            fields.append(("WARC-Segment-Total-Length", len(block)))
        yield _record(fields + common + [kind], part)


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name. Blanks around values are optional, a line that starts with one goes on with the last value, lines without a colon are passed over."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            out[last] = f"{out[last]} {line.strip()}"
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def parse(data: bytes):
    """The records of an archive: (header fields by lower-case name, block). Lengths are checked.

    The archive may be compressed, as one gzip member or many; one record is expanded at a time.
    """
    raw = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        version = line.strip()
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line.decode("utf-8", "replace").rstrip("\r\n"))
        fields = _fields(lines)
        if "content-length" not in fields:
            raise ValueError(f"record {fields.get('warc-record-id')} has no length")
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.readline().strip():
            raise ValueError(f"record {fields.get('warc-record-id')} does not end where it says")
        yield fields, block


def reassemble(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of segments (number, total or None, bytes), in any order.

    A segment that is there twice counts once; gaps and a wrong total raise ``ValueError``.
    """
    by_number = {n: (total, block) for n, total, block in segments}
    numbers = sorted(by_number)
    if numbers != list(range(1, len(numbers) + 1)):
        raise ValueError(f"segments {numbers} have a gap")
    block = b"".join(by_number[n][1] for n in numbers)
    total = by_number[numbers[-1]][0]
    if total != len(block):
        raise ValueError(f"segments hold {len(block)} bytes of {total}")
    return block


def _same_digest(told: str, data: bytes) -> bool:
    """Whether a digest field, in hexadecimal or base 32, is that of the data; other algorithms are not checked."""
    kind, _, value = told.rpartition(":")
    if kind.lower() not in ("sha1", ""):
        return True
    digest = hashlib.sha1(data).digest()
    return value.strip().lower() in (digest.hex(), base64.b32encode(digest).decode().lower())


def _page(fields: dict[str, str], block: bytes, verify: bool) -> tuple:
    """A row of the result: page id, uri, type, refers_to, digest, payload bytes, payload (null of a revisit)."""
    number = lambda k: int(fields[k]) if fields.get(k, "").lstrip("-").isdigit() else None
    uri, kind, told = fields.get("warc-target-uri"), fields["warc-type"], fields.get("warc-payload-digest")
    head, http, body = b"", {}, block
    if block.startswith(b"HTTP/"):
        head, _, body = block.partition(b"\r\n\r\n")
        http = _fields(head.decode("latin-1").split("\r\n")[1:])
    if kind == "revisit":
        size = http.get("content-length", "")
        return (number("x-page-id"), uri, kind, number("x-refers-to-page-id"), told and told.rpartition(":")[2], int(size) if size.isdigit() else None, None)
    payload = unframe(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    # Some writers state the digest of the body as it was sent.
    if verify and told and not _same_digest(told, payload) and not _same_digest(told, body):
        raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
    return (number("x-page-id"), uri, kind, None, hashlib.sha1(payload).hexdigest(), len(payload), payload)


#: Record types that hold or stand for a page; others (information, requests, metadata) are no pages.
PAGES = ("response", "resource", "revisit")
_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
_PAGE_DDL = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
_SEGMENT = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("head", pa.string()), ("block", pa.binary())])
_SEGMENT_DDL = "origin string, number long, total long, head string, block binary"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def repeated(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """Adds ``met``: whether a row's ``digest`` may be one of ``copies.of``; false only if it is not.

    A bitmap of the digests' hashes, of 8 MB at most, tells without moving rows.
    """
    place = lambda digest: F.shiftrightunsigned(F.xxhash64(digest), 64 - BITMAP_BITS) + 1
    block = F.bitmap_bucket_number(place("of")).alias("__block")
    blocks = copies.groupBy(block).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place("of"))).alias("__bits"))
    bit = F.bitmap_bit_position(place("digest"))
    byte = F.conv(F.hex(F.substr("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    told = rows.join(F.broadcast(blocks), F.bitmap_bucket_number(place("digest")) == F.col("__block"), "left")
    return told.withColumn("met", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("__block", "__bits")


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write a record for each row; payloads are UTF-8 texts, null ones empty.

    Among equal payloads of ``revisit_bytes`` or more the largest page id is the
    response; rows that repeat it are responses too. Rows without an id revisit it if it
    has one, and are responses otherwise. A table without rows writes no record; other
    columns are ignored.
    """
    text = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text.alias("html"), F.sha1(F.encode(text, "UTF-8")).alias("digest"))
    long = rows.where(F.octet_length("html") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    # Two keys, so that the rows of a frequent payload keep an exchange that can be split.
    copies, _ = materialize(long.where("n > 1").select(F.substring("digest", 1, 4).alias("part"), F.col("digest").alias("of"), "keeper"), "warc-copies")
    told = repeated(rows, copies)
    met = told.where("met").join(copies, (F.substring("digest", 1, 4) == F.col("part")) & (F.col("digest") == F.col("of")), "left")
    revisits = F.when(F.col("page_id").isNull() | (F.col("keeper") != F.col("page_id")), F.col("keeper"))
    names = ("page_id", "url", "html", "digest")
    placed = told.where("not met").select(*names, F.lit(None).cast("long").alias("refers_to")).union(met.select(*names, revisits.alias("refers_to")))

    if not 0 < segment_bytes < 1 << 23:
        raise ValueError("segments have to be shorter than 8 MB")

    def run(batches):
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, size = [], 0
            for page_id, url, html, digest, refers_to in zip(*(c for c in batch.columns)):
                row += 1
                for r in records(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8"), digest.as_py(), refers_to.as_py(), f"{part}/{row}", segment_bytes):
                    member = gzip.compress(r, 6, mtime=0)
                    out.append(member[:-1])  # the writer adds the zero byte that ends a member
                    size += len(member)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    members = placed.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", FILE_BYTES // (segment_bytes + HEAD_BYTES)).text(path)
    # Spark's first task makes a file even if it has no row.
    first, fs = hadoop(pages.sparkSession, f"{path}/part-00000-*")
    for status in fs.globStatus(first):
        if not status.getLen():
            fs.delete(status.getPath(), False)


def _files(spark: SparkSession, path: str, names: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("content")


def read_records(spark: SparkSession, path: str, names: str = FILE_NAMES) -> DataFrame:
    """All records of archives as they stand: ``record_id, record_type, url, headers, block``; segments are not joined."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])

    def scan(batches):
        for batch in batches:
            for content in batch.column(0):
                for fields, block in parse(content.as_py()):
                    yield _batch([(fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), list(fields.items()), block)], schema)

    return _files(spark, path, names).mapInArrow(scan, "record_id string, record_type string, url string, headers map<string,string>, block binary")


def read_warc(spark: SparkSession, path: str, *, names: str = FILE_NAMES, verify: bool = True) -> DataFrame:
    """The pages of archives: ``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload``.

    Any archive will do, compressed or not; records of types other than ``PAGES`` are left
    out, and ``page_id`` and ``refers_to`` are null where an archive does not carry them.
    The archives are read for whole records, which are decoded where they are read, and
    again for segments: these alone are shuffled, by their origin, and put together there;
    a group is one page's record. Nothing of an archive is kept elsewhere. Damaged archives
    raise, and with ``verify`` so do wrong SHA-1 digests. No file gives no row.
    """

    def whole(fields: dict[str, str], block: bytes) -> tuple | None:
        return None if "warc-segment-number" in fields or fields.get("warc-type") not in PAGES else _page(fields, block, verify)

    def segment(fields: dict[str, str], block: bytes) -> tuple | None:
        if "warc-segment-number" not in fields:
            return None
        total = fields.get("warc-segment-total-length")
        origin = fields.get("warc-segment-origin-id", fields.get("warc-record-id"))
        return (origin, int(fields["warc-segment-number"]), total and int(total), json.dumps(fields), block)

    def scan(take, schema: pa.Schema):
        def run(batches):
            for batch in batches:
                for content in batch.column(0):
                    out, size = [], 0
                    for fields, block in parse(content.as_py()):
                        if (row := take(fields, block)) is None:
                            continue
                        out.append(row)
                        size += len(block)
                        if size > BATCH_BYTES:
                            yield _batch(out, schema)
                            out, size = [], 0
                    yield _batch(out, schema)

        return run

    def join(table: pa.Table):
        rows = table.to_pylist()
        first = next((r for r in rows if r["number"] == 1), None)
        block = reassemble([(r["number"], r["total"], r["block"]) for r in rows])
        fields = json.loads(first["head"])
        if fields.get("warc-type") in PAGES:
            yield _batch([_page(fields, block, verify)], _PAGE)

    files = _files(spark, path, names)
    parts = files.mapInArrow(scan(segment, _SEGMENT), _SEGMENT_DDL).select(*(k.alias(n) for k, n in zip(text_key(F.col("origin")), "ab")), "number", "total", "head", "block")
    return files.mapInArrow(scan(whole, _PAGE), _PAGE_DDL).union(in_groups(parts, ["a", "b"], join, _PAGE_DDL))


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the pages as archives and read them back; options are those of ``write_warc``."""
    path = path or scratch(pages.sparkSession, "warc")
    write_warc(pages, path, **options)
    return read_warc(pages.sparkSession, path)
