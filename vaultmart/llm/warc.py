"""WARC archives in seekable Zstandard bundles (operator 7).

Records are packed into independent Zstandard frames; a bundle ends with a
skippable frame that holds the seek table (compressed and raw size of every
frame) and a fixed footer, so any frame is reached with two range reads and
decompressed alone.  The index maps a record id to (bundle, frame, offset in
the frame's raw bytes).

Equal payloads of at least ``min_bytes`` are stored once: the page with the
largest id is the response, the others are revisit records that name it.

Each task writes the bundles of its own rows, streaming one frame at a time,
under a file name that no other attempt uses; the index lists only bundles of
attempts that Spark counted, so retries and speculation leave unlisted files
at worst.  Archives go through pyarrow's file systems to the given folder (a
shared one), page tables are read by Spark.

Edge cases: null html is the empty payload; a null url gives no target line;
control characters of a url are percent-encoded; rows that repeat an id and
payload are all responses if the id is the largest of its group; rows without
id are never referred to unless their whole group has none; extra columns are
ignored; no rows give no bundles and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")                 # frames, descriptor, magic
ENTRY = struct.Struct("<II")                   # compressed size, raw size
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10        # raw bytes after which a frame is closed
BUNDLE_BYTES = 512 << 20       # compressed bytes after which a bundle is closed
READ_BYTES = 16 << 20          # raw bytes of records that a reading task is given
RECORD_DATE = "2024-01-01T00:00:00Z"


def file_system(uri: str):
    """(file system, path) of a folder URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record; a revisit carries the HTTP head only, with size and digest of the whole payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers and HTTP length, payload, end offset) of the record at ``at``."""
    top = raw.index(b"\r\n\r\n", at)
    lines = raw[at:top].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    end = top + 4 + int(head["Content-Length"])
    if raw[end:end + 4] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    body = raw.index(b"\r\n\r\n", top + 4) + 4
    head["http_length"] = int(re.search(rb"Content-Length: (\d+)", raw[top + 4:body])[1])
    return head, raw[body:end], end + 4


class BundleWriter:
    """Streams frames to a bundle file and closes it with the seek table."""

    def __init__(self, uri: str, name: str, level: int = 3):
        import zstandard

        self.fs, folder = file_system(uri)
        self.fs.create_dir(folder, recursive=True)
        self.out = self.fs.open_output_stream(f"{folder}/{name}", compression=None)      # the frames are ours, not the file system's
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.sizes: list[tuple[int, int]] = []
        self.written, self.open = 0, bytearray()

    def add(self, record: bytes) -> tuple[int, int]:
        """Append a record; returns (frame, offset in the frame)."""
        if len(self.open) >= FRAME_BYTES:
            self.flush()
        at = (len(self.sizes), len(self.open))
        self.open += record
        return at

    def flush(self):
        if self.open:
            frame = self.compress(bytes(self.open))
            self.out.write(frame)
            self.sizes.append((len(frame), len(self.open)))
            self.written += len(frame)
            self.open = bytearray()

    def close(self):
        self.flush()
        table = b"".join(ENTRY.pack(*s) for s in self.sizes) + FOOTER.pack(len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


def seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, raw size) of every frame, from the file's end."""
    frames, _, magic = FOOTER.unpack(f.read_at(FOOTER.size, size - FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    raw = f.read_at(frames * ENTRY.size, size - FOOTER.size - frames * ENTRY.size)
    out, at = [], 0
    for packed, plain in ENTRY.iter_unpack(raw):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(f, start: int, packed: int, plain: int) -> bytes:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompressobj().decompress(f.read_at(packed, start))
    if len(raw) != plain:
        raise ValueError("a frame differs from its seek table entry")
    return raw


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int = 0) -> DataFrame:
    """``id, url, html, refers_to``: the id of the response for revisits, else null."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("html", 256))).withColumn("bytes", F.length("html"))
    keys = ["sha", "bytes"]
    groups = (rows.where(F.col("bytes") >= min_bytes).groupBy(*keys).agg(F.max("id").alias("response"), F.count("*").alias("uses"))
              .where("uses > 1").withColumn("again", F.hash(*keys)).drop("uses"))
    # one more join key than grouping keys: both sides are exchanged anew, and a hot payload's rows can be split
    return (rows.withColumn("again", F.hash(*keys)).join(groups, [*keys, "again"], "left")
            .select("id", "url", "html", F.when(F.col("id").isNull() | (F.col("id") < F.col("response")), F.col("response")).alias("refers_to")))


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write bundles; returns (lazily) the index ``id, bundle, frame, offset``. Store it: running it writes the bundles."""
    schema = T.StructType([marked.schema["id"], T.StructField("bundle", T.StringType()),
                           T.StructField("frame", T.IntegerType()), T.StructField("offset", T.IntegerType())])

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        stem = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:12]}"
        writer, count, name = None, 0, ""
        for b in batches:
            where = []
            for i, url, html, refers in zip(*(b.column(c) for c in ("id", "url", "html", "refers_to"))):
                if writer is None:
                    name = f"{stem}-{count:04d}.warc.zst"
                    writer, count = BundleWriter(folder, name), count + 1
                record = build_record(i.as_py(), url.as_py(), html.as_py(), refers.as_py())
                where.append((name, *writer.add(record)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([w[0] for w in where], pa.string()), pa.array([w[1] for w in where], pa.int32()),
                 pa.array([w[2] for w in where], pa.int32())], names=schema.names)
        if writer:
            writer.close()

    return marked.mapInArrow(write, schema)


def bundle_frames(index: DataFrame, folder: str) -> DataFrame:
    """``bundle, frame, start, packed, plain`` of every frame, from the seek tables of the indexed bundles."""

    def frames(batches):
        fs, path = file_system(folder)
        for b in batches:
            for name in b.column("bundle").to_pylist():
                with fs.open_input_file(f"{path}/{name}") as f:
                    rows = seek_table(f, f.size())
                yield pa.RecordBatch.from_pylist([{"bundle": name, "frame": i, "start": s, "packed": p, "plain": r}
                                                  for i, (s, p, r) in enumerate(rows)], schema=kind)

    kind = pa.schema([("bundle", pa.string()), ("frame", pa.int32()), ("start", pa.int64()), ("packed", pa.int64()), ("plain", pa.int64())])
    # a number given: adaptive execution would put these few bytes into one task, which then opens every bundle
    tasks = index.sparkSession.sparkContext.defaultParallelism
    return index.select("bundle").distinct().repartition(tasks, "bundle").mapInArrow(frames, "bundle string, frame int, start long, packed long, plain long")


def _page_id(record_id: str) -> str | None:
    return record_id[len("<urn:page:"):-1] or None


def read_archives(index: DataFrame, folder: str, stored) -> DataFrame:
    """Read every record back: ``id, payload_bytes, payload_digest,
    record_type, refers_to, frame, offset, bundle, payload``.  Frames are the
    unit of work, dealt over one task per ``READ_BYTES`` of records (their own
    few bytes say nothing about the work); a response's digest is computed
    again from its payload."""
    kind = T.StructType([T.StructField("id", T.StringType()), T.StructField("payload_bytes", T.LongType()),
                         T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
                         T.StructField("refers_to", T.StringType()), T.StructField("bundle", T.StringType()),
                         T.StructField("frame", T.IntegerType()), T.StructField("offset", T.IntegerType()),
                         T.StructField("payload", T.BinaryType())])
    arrow = pa.schema([("id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("payload", pa.binary())])

    def read(batches):
        fs, path = file_system(folder)
        for b in batches:
            for row in b.to_pylist():
                with fs.open_input_file(f"{path}/{row['bundle']}") as f:
                    raw = read_frame(f, row["start"], row["packed"], row["plain"])
                rows, at = [], 0
                while at < len(raw):
                    head, payload, end = parse_record(raw, at)
                    revisit = head["WARC-Type"] == "revisit"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (payload_digest(payload) != digest or len(payload) != head["http_length"]):
                        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                    rows.append({"id": _page_id(head["WARC-Record-ID"]), "payload_bytes": head["http_length"], "payload_digest": digest,
                                 "record_type": head["WARC-Type"], "refers_to": _page_id(head["WARC-Refers-To"]) if revisit else None,
                                 "bundle": row["bundle"], "frame": row["frame"], "offset": at, "payload": None if revisit else payload})
                    at = end
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    found = stored(bundle_frames(index, folder), "warc-frames")
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-(found.agg(F.sum("plain")).first()[0] or 0) // READ_BYTES))
    return found.repartition(tasks, "bundle", "frame").mapInArrow(read, kind)


def fetch(index: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """Random access: ``id, headers, payload`` of the wanted ids (a one-column frame ``id``), one frame read per record."""
    kind = T.StructType([index.schema["id"], T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
                         T.StructField("payload", T.BinaryType())])

    def get(batches):
        fs, path = file_system(folder)
        for b in batches:
            for row in b.to_pylist():
                with fs.open_input_file(f"{path}/{row['bundle']}") as f:
                    raw = read_frame(f, *seek_table(f, f.size())[row["frame"]])
                head, payload, _ = parse_record(raw, row["offset"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["id"]], b.schema.field("id").type),
                     pa.array([[(k, str(v)) for k, v in head.items()]], pa.map_(pa.string(), pa.string())),
                     pa.array([payload], pa.binary())], names=["id", "headers", "payload"])

    return index.join(ids.select("id").distinct(), "id").mapInArrow(get, kind)
