"""WARC archives as seekable Zstandard bundles.

Writing: each task groups its records into bundles; a bundle is a run of independent Zstandard frames of about
`frame_bytes` of records each, closed by a skippable frame that holds the seek table (compressed and decompressed size
of every frame, then the count, flags and the seekable magic number, in the public seekable format). The index maps a
record identifier to its bundle, frame and offset within the decompressed frame.

Equal payloads: the digest of every payload is grouped (partial counts first, so one digest on a third of all pages is
no hot task), and only digests that occur more than once come back to the pages: broadcast if they are few (a checked
count), so pages stay in their tasks; else by a join on digest and a salt, so a digest on a third of all pages is dealt to
many tasks.

Bundles are written through pyarrow.fs to the shared folder, under names of their own for every attempt of a task. The
index, which Spark commits once a task, names the bundles of the attempts that count; those of lost, repeated or
speculative attempts are never named by it and can be deleted at any time.

Defined cases: null html is an empty payload; payloads under `min_revisit` bytes are always responses; of equal
payloads the largest page_id is the response (null is smaller than any id, and repeated rows of that id are all
responses, under the one record id that the revisits refer to); null url is an empty target; an empty table writes no bundle.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, cut, fresh_path, map_arrow, text_bytes

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX = "bundle string, record_id string, frame int, offset bigint, length bigint"
RECORDS = "record_id string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def filesystem(uri: str):
    """The file system and the path in it of a folder that all machines reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def shared_id(page_id: int, digest: str) -> str:
    """The record id of the response of a payload that others repeat: known before anything is written."""
    return f"{page_id}:{digest}"


def record_bytes(record_id: str, kind: str, url: str, page_id: int | None, digest: str, size: int, refers_to: int | None, payload: bytes) -> bytes:
    target = "".join(c for c in url if c not in "\r\n")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>", f"WARC-Target-URI: {target}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{shared_id(refers_to, digest)}>"]
    body = b"" if kind == "revisit" else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    return fields, rest[: int(fields["Content-Length"])]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable footer: sizes of the frames, their count, no checksums, the magic number."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of every frame of an open bundle, from its footer alone."""
    size = source.size()
    count, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entries, at, out = source.read_at(8 * count, size - 9 - 8 * count), 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", entries, 8 * i)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(source, table: list[tuple[int, int, int]], frame: int) -> bytes:
    start, packed, plain = table[frame]
    return zstandard.ZstdDecompressor().decompress(source.read_at(packed, start), max_output_size=plain)


def read_record(bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Random access: one record by what the index says of it."""
    fs, path = filesystem(bundle)
    with fs.open_input_file(path) as source:
        return parse_record(read_frame(source, read_seek_table(source), frame)[offset : offset + length])


class Bundle:
    """Frames and the index of one bundle in memory (bounded by its target size and one record)."""

    def __init__(self, frame_bytes: int, level: int) -> None:
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.out, self.frames, self.open, self.index, self.size = [], [], bytearray(), [], 0

    def add(self, record_id: str, data: bytes) -> None:
        self.index.append((record_id, len(self.frames), len(self.open), len(data)))
        self.open += data
        if len(self.open) >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self.out.append(self.packer.compress(bytes(self.open)))
            self.frames.append((len(self.out[-1]), len(self.open)))
            self.size += len(self.out[-1])
            self.open = bytearray()

    def write(self, uri: str) -> list[tuple]:
        self.close_frame()
        fs, path = filesystem(uri)
        with fs.open_output_stream(path, compression=None) as to:
            for part in [*self.out, seek_table(self.frames)]:
                to.write(part)
        return [(uri, *x) for x in self.index]


def plan_records(pages: DataFrame, scratch: Scratch, min_revisit: int = 1000, most: int = 500_000, salts: int = 64) -> DataFrame:
    """page_id, url, html, digest, size, record_type, refers_to, repeated (whether other records refer to this one)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    many = own.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    many = scratch.cut(many)
    if many.count() <= most:
        known = own.join(F.broadcast(many), "digest", "left")
    else:
        salted = many.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        known = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(salted, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return known.select("page_id", "url", "html", "digest", "size", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"), (F.col("first").isNotNull() & ~revisit).alias("repeated"))


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = 1 << 20, bundle_bytes: int = 64 << 20, level: int = 3, min_revisit: int = 1000, most: int = 500_000) -> DataFrame:
    """Write the archives; returns the written index (record id -> bundle, frame, offset in the frame, length)."""
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)

    def per_task(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), uuid.uuid4().hex[:16]
        count, serial, bundle = 0, 0, Bundle(frame_bytes, level)

        def flush():
            nonlocal count, bundle
            rows = bundle.write(f"{folder}/part-{part:06d}-{count:05d}-{attempt}.warc.zst")
            count, bundle = count + 1, Bundle(frame_bytes, level)
            return dict(zip(("bundle", "record_id", "frame", "offset", "length"), map(list, zip(*rows, strict=True)), strict=True))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "record_type", "refers_to", "repeated")]
            for payload, page_id, url, digest, size, kind, refers_to, repeated in zip(text_bytes(batch.column("html")), *columns, strict=True):
                record_id = shared_id(page_id, digest) if repeated else f"{page_id if page_id is not None else 'none'}:{part}:{serial}"
                serial += 1
                bundle.add(record_id, record_bytes(record_id, kind, url or "", page_id, digest, size, refers_to, payload))
                if bundle.size >= bundle_bytes:
                    yield flush()
        if bundle.index:
            yield flush()

    scratch = Scratch()
    planned = plan_records(pages, scratch, min_revisit, most)
    index = cut(map_arrow(planned, ["page_id", "url", "html", "digest", "size", "record_type", "refers_to", "repeated"], per_task, INDEX))
    scratch.drop_all()
    return index


def read_bundles(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the bundles that the index names, read through their seek tables, frame by frame. The digest and
    size of a response are taken anew from its payload and held against its header."""
    # One row per (bundle, frame), in tasks of its own: frames are independent.
    frames = index.select("bundle", "frame").distinct()
    frames = frames.repartition(max(1, min(2_000, frames.count() // 4)), "bundle", "frame")

    def per_task(batches):
        for batch in batches:
            for bundle, frame in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                fs, path = filesystem(bundle)
                with fs.open_input_file(path) as source:
                    data = read_frame(source, read_seek_table(source), frame)
                yield _columns(records(data), with_payload)

    return map_arrow(frames, ["bundle", "frame"], per_task, RECORDS + ", payload binary" * with_payload)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at) + 4
        fields = _fields(data[at:stop])
        n = int(fields["Content-Length"])
        yield fields, data[stop : stop + n]
        at = stop + n + 4


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.partition(": ")[::2] for line in head.decode().split("\r\n")[1:] if line)


def _columns(found, with_payload: bool) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("record_id", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
    for fields, body in found:
        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
        if fields["WARC-Type"] == "response" and (hashlib.sha1(body).hexdigest() != digest or len(body) != size):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        refers = fields.get("WARC-Refers-To")
        for k, v in (
            ("record_id", fields["WARC-Record-ID"][len("<urn:page:") : -1]), ("page_id", int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None), ("url", fields["WARC-Target-URI"]),
            ("payload_bytes", size), ("payload_digest", digest), ("record_type", fields["WARC-Type"]), ("refers_to", int(refers[len("<urn:page:") : -1].partition(":")[0]) if refers else None), ("payload", body),
        ):
            out[k].append(v)
    return out if with_payload else {k: v for k, v in out.items() if k != "payload"}


def archive(pages: DataFrame, spark: SparkSession, folder: str | None = None) -> DataFrame:
    """Write the pages' archives and read them back."""
    return read_bundles(write_bundles(pages, folder or fresh_path(spark, "warc")))
