"""WARC archives: written from rows by Spark tasks, read back sequentially.

Writing.  Of records with equal payloads of at least ``least_bytes`` the one
with the greatest key is a response; the others are revisits that carry its
record id and no payload.  A task writes its rows to archives of its own in the
shared folder, one gzip member per record, and starts another archive when
one is full.  Archives of attempts that were lost stay unread: only the names in
the returned manifest count, and every attempt writes under a new name.

Reading.  An archive is one task's work, read from front to back in blocks.
Each gzip member is inflated incrementally; the header block ends at the first
empty line and Content-Length frames the rest, so no record is guessed from its
content.  Block and payload digests are verified.  A member that is cut off, has
a wrong checksum, frame or digest, gives a row whose ``problem`` says so;
after one whose end can't be found, the archive's rest is not read.  Memory is
one block of the file and one record.

Defined cases: a null payload is empty; a null key is smaller than any other,
and rows that share the greatest key are all responses; repeated rows give a
record each; a null target is no header line; line breaks inside a target are
percent-encoded; an empty table gives no archive and no rows; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import cut, importable, shared_folder

#: Compressed bytes after which a task starts another archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes read from an archive, and inflated from a member, at a time.
BLOCK = 1 << 20
#: The date of records whose rows have none.
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as any executor opens it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def sha1_field(digest: bytes) -> str:
    """The form that digests have in headers."""
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(key: int | None, digest: bytes) -> str:
    """A name that a revisit can tell for the response it refers to."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{key}|'.encode() + digest).digest()[:16], version=5)}>"


def record(key: int | None, target: str | None, payload: bytes | None, digest: bytes, size: int, refers_to: int | None = None,
           revisit: bool = False, date: str = DATE) -> bytes:
    """One record, not yet compressed; ``payload`` is None for revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {sha1_field(digest)}",
            f"WARC-Block-Digest: {sha1_field(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    if target is not None:
        head.append("WARC-Target-URI: " + target.replace("\r", "%0D").replace("\n", "%0A"))
    if key is not None:
        head.append(f"X-Row-Key: {key}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + END + block + END


def member(data: bytes, level: int = 6) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def with_kinds(rows: DataFrame, least_bytes: int) -> DataFrame:
    """key, target, payload, sha1, size, and for revisits the response's key.

    Groups are those of equal SHA-256 and length.  The table of responses has a
    row for each payload that occurs more than once; it is written to the
    shared folder, so that the rows' side of the join is a plain exchange, in
    which Spark can split the rows of a hot payload.
    """
    hashed = rows.select("key", "target", "payload", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"),
                         F.sha2("payload", 256).alias("same"))
    large = hashed.where(F.col("size") >= least_bytes).groupBy(F.col("same").alias("_same"))
    responses = cut(large.agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_same", "response"))
    joined = hashed.join(responses, F.col("same") == F.col("_same"), "left")
    revisit = F.col("_same").isNotNull() & ~F.col("key").eqNullSafe(F.col("response"))
    return joined.select("key", "target", F.when(~revisit, F.col("payload")).alias("payload"), "sha1", "size", F.col("response"),
                         revisit.alias("revisit"))


def write(rows: DataFrame, key: str, target: str, payload: str, folder: str, least_bytes: int = 1000,
          archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row; returns the manifest (path, records, bytes) of the archives."""
    importable(rows)
    prepared = with_kinds(rows.select(rows[key].cast("long").alias("key"), rows[target].cast("string").alias("target"),
                                      F.coalesce(rows[payload].cast("string"), F.lit("")).cast("binary").alias("payload")), least_bytes)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = store(folder)
        done, out, path, records, size = [], None, "", 0, 0

        def close():
            out.close()
            done.append((path, records, size))

        for batch in source:
            for k, uri, body, sha1, length, response, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(path, compression=None)
                data = member(record(k, uri, body, bytes.fromhex(sha1), length, response if revisit else None, revisit))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(p, n, b) for p, n, b in done])], names=["path", "records", "bytes"])

    manifest = cut(prepared.mapInArrow(batches, "path string, records long, bytes long"))
    prefix = folder[:folder.index("://") + 3] if "://" in folder and not folder.startswith("file:") else ""
    return manifest.withColumn("path", F.concat(F.lit(prefix), "path"))


@dataclass
class Record:
    """What the reader gives of one member."""

    offset: int
    problem: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def framed(offset: int, data: bytes) -> Record:
    """A record of an inflated member: header lines, Content-Length, digests."""
    cut_at = data.find(END)
    if not data.startswith(b"WARC/") or cut_at < 0:
        return Record(offset, "no WARC header")
    headers = {}
    for line in data[:cut_at].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return Record(offset, "header line without a colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return Record(offset, "no Content-Length", headers)
    at = cut_at + 4
    block = data[at:at + int(length)]
    if len(block) < int(length) or data[at + int(length):] != END:
        return Record(offset, "Content-Length does not frame the record", headers)
    said = headers.get("warc-block-digest")
    if said is not None and said != sha1_field(hashlib.sha1(block).digest()):
        return Record(offset, "block digest differs", headers)
    http = headers.get("content-type", "").startswith("application/http")
    top, gap, payload = block.partition(END) if http else (b"", b"", block)
    for line in top.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers["http-" + name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    said = headers.get("warc-payload-digest")
    if headers.get("warc-type") != "revisit" and said is not None and said != sha1_field(hashlib.sha1(payload).digest()):
        return Record(offset, "payload digest differs", headers)
    return Record(offset, None, headers, payload)


def records_of(stream, block: int = BLOCK) -> Iterator[Record]:
    """The records of an open archive, in order, read and inflated block by block."""
    rest, start, place = b"", 0, 0   # bytes read but not inflated; where the member began; bytes consumed
    while True:
        if not rest:
            rest = stream.read(block)
            if not rest:
                return
        start, inflate, pieces = place, zlib.decompressobj(31), []
        try:
            while not inflate.eof:
                if not rest:
                    rest = stream.read(block)
                    if not rest:
                        yield Record(start, "archive ends inside a member")
                        return
                pieces.append(inflate.decompress(rest, block))
                left = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                place += len(rest) - len(left)
                rest = left
                while not inflate.eof and not rest and pieces[-1]:   # what the window still holds
                    more = inflate.decompress(b"", block)
                    if not more:
                        break
                    pieces.append(more)
        except zlib.error as e:
            yield Record(start, f"not a gzip member: {e}")
            return
        yield framed(start, b"".join(pieces))


#: archive, offset of the member, problem, the fields that most readers want, every header, the payload
FIELDS = ("archive string, offset long, problem string, warc_type string, record_id string, refers_to string, target_uri string, "
          "warc_date string, payload_digest string, headers map<string,string>, payload binary")
SCHEMA = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("problem", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()),
                    ("refers_to", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()), ("payload_digest", pa.string()),
                    ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
#: Bytes of payload after which a batch of records is handed on.
BATCH_BYTES = 8 << 20


def read_archives(paths: DataFrame, column: str = "path", tasks: int | None = None) -> DataFrame:
    """Every record of the archives named in ``column``, each archive read by one task; the row of a bad record has a ``problem``."""
    importable(paths)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def out():
            return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

        for batch in source:
            for path in batch.column(0).to_pylist():
                files, name = store(path)
                with files.open_input_stream(name, compression=None) as stream:
                    for r in records_of(stream):
                        h = r.headers
                        digest = h.get("warc-payload-digest", "")
                        rows.append({"archive": path, "offset": r.offset, "problem": r.problem, "warc_type": h.get("warc-type"),
                                     "record_id": h.get("warc-record-id"), "refers_to": h.get("warc-refers-to"), "target_uri": h.get("warc-target-uri"),
                                     "warc_date": h.get("warc-date"), "payload_digest": hex_digest(digest), "headers": list(h.items()), "payload": r.payload})
                        held += len(r.payload) + 1024
                        if held >= BATCH_BYTES:
                            yield out()
                            rows, held = [], 0
        if rows:
            yield out()

    named = paths.select(F.col(column).alias("path")).where("path IS NOT NULL")
    tasks = tasks or max(1, min(named.count(), int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return named.repartitionByRange(tasks, "path").mapInArrow(batches, FIELDS)


def hex_digest(said: str) -> str | None:
    """Lower-case hex of a sha1 header value; None where it is not one."""
    kind, _, value = said.partition(":")
    try:
        return base64.b32decode(value).hex() if kind == "sha1" else None
    except ValueError:
        return None


def resolved(records: DataFrame) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to of good records; a bad one fails the job.

    A revisit's digest must be that of the response it names: the key of the
    response is looked up by record id among the responses that were read.
    """
    ok = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("bad WARC record in "), "archive", F.lit(" at "), F.col("offset").cast("string"),
                                                                     F.lit(": "), "problem")).cast("string")).otherwise(F.col("warc_type"))
    rows = cut(records.select(F.col("headers")["x-row-key"].cast("long").alias("key"), ok.alias("record_type"), "record_id", F.col("refers_to").alias("refers_id"), "payload_digest",
                              F.when(F.col("warc_type") == "revisit", F.col("headers")["http-content-length"].cast("long"))
                              .otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes")))
    asked = rows.where("record_type = 'revisit'").select(F.col("refers_id").alias("_asked")).distinct()
    answers = cut(rows.where("record_type = 'response'").join(asked, F.col("record_id") == F.col("_asked"), "left_semi")
                  .groupBy(F.col("record_id").alias("_id")).agg(F.max("key").alias("refers_to"), F.max("payload_digest").alias("_digest")))
    revisits = rows.where("record_type = 'revisit'").join(answers, F.col("refers_id") == F.col("_id"), "left")
    checked = F.when(F.col("payload_digest").eqNullSafe(F.col("_digest")), F.col("refers_to")).otherwise(
        F.raise_error(F.concat(F.lit("revisit without its response: "), F.coalesce("record_id", F.lit("?")))).cast("long"))
    columns = ["key", "payload_bytes", "payload_digest", "record_type"]
    return (rows.where("record_type <> 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select(*columns, checked.alias("refers_to"))))


def fresh_folder(spark: SparkSession) -> str:
    """A new folder for archives under the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"


def round_trip(rows: DataFrame, key: str, target: str, payload: str, least_bytes: int = 1000, folder: str | None = None) -> DataFrame:
    """Write the rows to archives and read them back: ``resolved`` of every record."""
    manifest = write(rows, key, target, payload, folder or fresh_folder(rows.sparkSession), least_bytes)
    return resolved(read_archives(manifest))
