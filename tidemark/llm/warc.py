"""WARC archives as seekable Zstandard bundles.

Writing: records are grouped into independent Zstandard frames of about ``frame_bytes``;
a bundle is a run of frames followed by a seek table (a skippable frame with the compressed
and plain size of every frame, in the public seekable format).  An index maps each record
identifier to its bundle, frame and offset within the frame.

Of records with equal payloads (of at least ``revisit_least`` bytes) the one with the
largest identifier is a ``response``, the others are ``revisit`` records that refer to it.
The decision is made on digests alone, first within blocks of rows, then over blocks, and
goes back block by block, so a payload that a third of all pages share never meets in one
task.

Every task writes its bundles to the shared folder under names of its own and reports them
in the index table; an index row exists only for tasks that were committed, so a bundle that
a lost or repeated task left behind is never read.  Reading starts from the bundles' seek
tables; frames are dealt to the cluster one by one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_partitions, take, text_of
from tidemark.session import scratch_path, ship_package

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the seekable format and of the WARC revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SAFE = "!#$%&'()*+,/:;=?@[]~-._"

INDEX = ("uid long, record_id string, bundle string, frame int, offset long, length long")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_id(run: str, uid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{run}:{uid}'.encode()).digest())}>"


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def page_record(run: str, row: dict) -> bytes:
    """The response or revisit record of a page; a revisit has the HTTP head alone."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['n_bytes']}\r\n\r\n").encode()
    revisit = row["target"] is not None

    def text(v) -> str | None:
        return None if v is None else quote(str(v), safe=SAFE)

    return record([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(run, row["uid"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", text(row["url"])),
        ("WARC-Payload-Digest", "sha1:" + base32(row["digest"])),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(run, row["target"]) if revisit else None),
        ("X-Page-ID", text(row["id"])),
        ("X-Refers-To-Page-ID", text(row["target_id"]) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ], http if revisit else http + row["payload"])


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of every record of a frame."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/1.1\r\n", at):
            raise ValueError("a frame does not start with a record")
        head_end = data.index(b"\r\n\r\n", at) + 4
        fields = dict(line.split(": ", 1) for line in data[at:head_end - 4].decode("utf-8").split("\r\n")[1:])
        end = head_end + int(fields["Content-Length"])
        yield at, end + 4 - at, fields, data[head_end:end]
        at = end + 4


class BundleWriter:
    """One bundle: frames, then the seek table."""

    def __init__(self, folder: str, name: str, frame_bytes: int):
        fs, path = pafs.FileSystem.from_uri(folder)
        self.uri, self.frame_bytes = f"{folder}/{name}", frame_bytes
        fs.create_dir(path, recursive=True)
        self.out = fs.open_output_stream(f"{path}/{name}", compression=None)
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.entries: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.plain = self.written = 0
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                         ("WARC-Date", DATE), ("WARC-Filename", name),
                         ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self.flush()

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        if self.plain and self.plain + len(data) > self.frame_bytes:
            self.flush()
        at = self.plain
        self.parts.append(data)
        self.plain += len(data)
        return len(self.entries), at

    def flush(self) -> None:
        if self.parts:
            frame = self.zip.compress(b"".join(self.parts))
            self.out.write(frame)
            self.entries.append((len(frame), self.plain))
            self.written += len(frame)
            self.parts, self.plain = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", c, d) for c, d in self.entries)
        table += struct.pack("<IBI", len(self.entries), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame, from the bundle's footer."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        count, _, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        table = f.read_at(8 * count, size - 9 - 8 * count)
    out, at = [], 0
    for c, d in struct.iter_unpack("<II", table):
        out.append((at, c, d))
        at += c
    return out


def read_frame(uri: str, offset: int, size: int, plain: int) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        return zstandard.ZstdDecompressor().decompress(f.read_at(size, offset), max_output_size=plain)


def read_record(uri: str, frame: int, offset: int, length: int) -> bytes:
    """One record by its index entry: the seek table and a single frame are read."""
    return read_frame(uri, *seek_table(uri)[frame])[offset:offset + length]


def responses(rows: DataFrame, revisit_least: int) -> DataFrame:
    """``uid, target, target_id``: the response each row revisits, nulls for a response.

    ``rows`` has ``uid, id, digest, n_bytes``.
    """
    blocks = shuffle_partitions(rows)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    key = ["digest", "n_bytes"]
    last = F.struct(F.col("id").isNotNull().alias("has_id"), "id", (-F.col("uid")).alias("order"))
    local = materialize(rows.where(F.col("n_bytes") >= revisit_least).groupBy("block", *key)
                        .agg(F.max(last).alias("best")), "warc-local")
    top = local.groupBy(*key).agg(F.max("best").alias("best"))
    down = local.select("block", *key).join(top, key)
    target = -F.col("best.order")
    return (rows.join(down, ["block", *key], "left")
            .select("uid", F.when(target != F.col("uid"), target).alias("target"),
                    F.when(target != F.col("uid"), F.col("best.id")).alias("target_id")))


def write_archives(pages: DataFrame, folder: str | None = None, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES, revisit_least: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row; the index: ``uid, record_id, bundle, frame, offset, length``.

    Null payloads count as empty, and empty payloads are equal to one another.  A null url has
    no target field and a null identifier no page field; rows without an identifier rank
    below all others.  Of rows with the same payload and identifier the first is the
    response.  A record larger than a frame has a frame of its own.  An empty table writes
    no bundle and gives an empty index; other columns are ignored, whatever they are called.
    """
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, "llm-warc")
    run_id = uuid.uuid4().hex
    rows = take(pages, id=id_col, url=url_col, html=html_col)
    payload = F.encode(text_of("html"), "UTF-8")
    staged_path = scratch_path(spark, "llm-warc-pages")
    staged = rows.select("id", "url", payload.alias("payload"), F.monotonically_increasing_id().alias("uid"),
                         F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("n_bytes"))
    staged.write.option("compression", "zstd").parquet(staged_path)
    staged = spark.read.schema(staged.schema).parquet(staged_path)
    decided = staged.join(responses(staged.select("uid", "id", "digest", "n_bytes"), revisit_least), "uid")
    names = decided.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index = None, []

        def rows_out() -> pa.RecordBatch:
            columns = list(zip(*index)) or [()] * 6
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["uid", "record_id", "bundle", "frame", "offset", "length"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(j)[i].as_py() for j, k in enumerate(names)}
                if bundle is None:
                    number = TaskContext.get().partitionId()
                    bundle = BundleWriter(folder, f"{number:06d}-{uuid.uuid4().hex}.warc.zst", frame_bytes)
                data = page_record(run_id, row)
                index.append((row["uid"], record_id(run_id, row["uid"]), bundle.uri, *bundle.add(data), len(data)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    yield rows_out()
                    bundle, index = None, []
        if bundle is not None:
            bundle.close()
        yield rows_out()

    return materialize(decided.mapInArrow(run, INDEX), "warc-index")


def read_archives(index: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per page record of the index's bundles, read from the archives alone.

    ``record_id, page_id`` (text), ``url, record_type, payload_bytes, payload_digest,
    refers_to`` (text) and, if asked for, ``payload`` (null for revisits).  The payload of a
    response is checked against its digest and length.
    """
    spark = index.sparkSession
    ship_package(spark)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                entries = seek_table(uri)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(entries)), *[pa.array(c, pa.int64()) for c in zip(*entries)]],
                    names=["bundle", "offset", "size", "plain"])

    schema = ("record_id string, page_id string, url string, record_type string, payload_bytes long, "
              "payload_digest string, refers_to string" + (", payload binary" if payloads else ""))
    names = [f.split()[0] for f in schema.split(", ")]

    def plain(v: str | None) -> str | None:
        return None if v is None else unquote(v)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, *place in zip(*[c.to_pylist() for c in batch.columns]):
                out = []
                for _, _, fields, block in parse_records(read_frame(uri, *place)):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    head, _, body = block.partition(b"\r\n\r\n")
                    http = dict(x.split(": ", 1) for x in head.decode("ascii").split("\r\n")[1:])
                    size, digest = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    full = fields["WARC-Type"] == "response"
                    if full and (len(body) != size or base32(hashlib.sha1(body).digest()) != digest):
                        raise ValueError(f"{uri}: damaged payload of {fields['WARC-Record-ID']}")
                    out.append((fields["WARC-Record-ID"], plain(fields.get("X-Page-ID")),
                                plain(fields.get("WARC-Target-URI")), fields["WARC-Type"], size, digest,
                                plain(fields.get("X-Refers-To-Page-ID")), body if full else None)[:len(names)])
                if out:
                    types = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    parts = shuffle_partitions(index)
    bundles = index.select("bundle").distinct()
    places = bundles.mapInArrow(frames, "bundle string, offset long, size long, plain long")
    return places.repartition(parts, "bundle", "offset").mapInArrow(records, schema)


def fetch_records(wanted: DataFrame) -> DataFrame:
    """``record_id, record`` (its bytes) for index rows, each by one frame read."""
    ship_package(wanted.sparkSession)
    rows = wanted.select("record_id", "bundle", "frame", "offset", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = read_record(row["bundle"], row["frame"], row["offset"], row["length"])
                yield pa.RecordBatch.from_arrays([pa.array([row["record_id"]]), pa.array([data], pa.binary())],
                                                 names=["record_id", "record"])

    return rows.mapInArrow(run, "record_id string, record binary")
