"""Media columns: content-addressed payloads in tar shards.

A payload (a text's bytes, padded to whole picture rows) is kept as an 8-bit
grey PNG picture in a tar shard in the shared folder. Rows carry the payload's
digest, the shard, and the offset and length of the picture in it. Metadata
columns come from range reads of the headers alone: the member's tar header and
the picture's first bytes. Shards are named by their own content, so a task
that runs again writes the same file, and they are moved into place whole.
"""

from __future__ import annotations

import hashlib
import io
import math
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, checkpoint_dir, durable, texts

#: Samples of a picture row; bytes of a tar shard, about; level of the picture's compression.
ROW, SHARD_BYTES, LEVEL = 192, 16 << 20, 5
#: Bytes of pictures that a task reads, about.
READ_BYTES = 64 << 20
PAD = b"\x20"
PNG = b"\x89PNG\r\n\x1a\n"
TAR_HEADER, PNG_HEADER = 512, 33


def padded(data: bytes) -> bytes:
    """data with pad bytes up to a positive multiple of the row."""
    return data + PAD * (max(1, -(-len(data) // ROW)) * ROW - len(data))


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """An 8-bit grey picture of ROW columns whose samples are the payload's bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)  # each row begins with its filter, none
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", ROW, len(rows), 8, 0, 0, 0, 0)
    return PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample, from a picture's first bytes."""
    if data[:8] != PNG or data[12:16] != b"IHDR":
        raise ValueError("not a PNG picture")
    return struct.unpack(">IIB", data[16:25])


def from_png(data: bytes) -> bytes:
    width, height, _ = png_header(data)
    at, packed = 8, []
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        if kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += n + 12
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Rows, mean and spread of the samples, and which of 64 equal parts are brighter than the whole."""
    x = np.frombuffer(payload, np.uint8)
    bits = np.packbits(x.reshape(64, -1).mean(axis=1) > x.mean()).tobytes().hex()
    return f"{len(x) // ROW}x{ROW} mean={x.mean():.4f} std={x.std():.4f} bright={bits}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Shard:
    """A tar file in the making: each digest once."""

    def __init__(self):
        self.buffer, self.at = io.BytesIO(), {}
        self.tar = tarfile.open(fileobj=self.buffer, mode="w", format=tarfile.USTAR_FORMAT)

    def add(self, digest: str, media: bytes) -> None:
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(media)
        self.at[digest] = (self.tar.offset + TAR_HEADER, len(media))
        self.tar.addfile(info, io.BytesIO(media))

    def store(self, root: str) -> str:
        """Write it under root; its name is its content's digest."""
        self.tar.close()
        data = self.buffer.getvalue()
        name = hashlib.sha256(data).hexdigest()
        system, base = file_system(root)
        system.create_dir(f"{base}/{name[:2]}", recursive=True)
        part = f"{base}/{name[:2]}/{name}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part) as f:
            f.write(data)
        system.move(part, f"{base}/{name[:2]}/{name}.tar")
        return f"{name[:2]}/{name}.tar"


MANIFEST = "n_bytes long, digest string, shard string, offset long, length long"


def store_texts(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, digest, shard, offset, length. Writes shards under root as it is computed.

    A payload is stored once in a task; copies in other tasks' shards have the
    same digest and bytes. Rows wait for their shard, at most SHARD_BYTES of
    pictures or 50,000 rows.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored: dict[str, tuple[str, int, int]] = {}
        shard, ids, rows = Shard(), [], []

        def flush(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal shard
            if shard.at:
                name = shard.store(root)
                stored.update({d: (name, *where) for d, where in shard.at.items()})
            places = [stored[d] for _, d in rows]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array([n for n, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.string()),
                 *(pa.array([p[i] for p in places], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64())))],
                names=["id", "n_bytes", "digest", "shard", "offset", "length"],
            )
            shard = Shard()
            ids.clear()
            rows.clear()
            return out

        id_type = None
        for b in batches:
            id_type = b.schema.field("id").type
            for i, t in zip(b.column("id").to_pylist(), texts(b), strict=True):
                data = t.encode()
                payload = padded(data)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in stored and digest not in shard.at:
                    shard.add(digest, to_png(payload))
                ids.append(i)
                rows.append((len(data), digest))
                if shard.tar.offset >= SHARD_BYTES or len(rows) >= 50_000:
                    yield flush(id_type)
        if rows:
            yield flush(id_type)

    return arrow_task(slim, task, f"id {kind}, {MANIFEST}")


FEATURES = "digest string, shard string, offset long, length long, member string, width int, height int, sample_bits int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_media(places: DataFrame, root: str, headers_only: bool = False) -> DataFrame:
    """One row per row of places (digest, shard, offset, length), with what its range reads show.

    The headers give the member's name, its stored length, and the picture's
    size. Unless headers_only, the whole picture is read too and its payload
    hashed and measured; else those columns are null.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        name, f = None, None
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if r["shard"] != name:
                    if f:
                        f.close()
                    name, f = r["shard"], system.open_input_file(f"{base}/{r['shard']}")
                head = f.read_at(TAR_HEADER + PNG_HEADER, r["offset"] - TAR_HEADER)
                info = tarfile.TarInfo.frombuf(head[:TAR_HEADER], "utf-8", "strict")
                width, height, bits = png_header(head[TAR_HEADER:])
                rest = [None] * 4
                if not headers_only:
                    media = f.read_at(r["length"], r["offset"])
                    payload = from_png(media)
                    rest = [hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), hashlib.sha256(media).hexdigest(), feature(payload)]
                out.append((r["digest"], r["shard"], r["offset"], r["length"], info.name, width, height, bits, width * height * bits // 8, rest[0], rest[1], info.size, rest[2], rest[3]))
            kinds = [pa.string()] * 2 + [pa.int64()] * 2 + [pa.string()] + [pa.int32()] * 3 + [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = [x.split()[0] for x in FEATURES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds], names=names)
        if f:
            f.close()

    return arrow_task(places.select("digest", "shard", "offset", "length"), task, FEATURES)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", root: str | None = None) -> DataFrame:
    """One row per row of docs: id, n_bytes, digest, and the columns of read_media.

    Texts are stored under root, by default in the shared checkpoint folder.
    Null and empty texts are payloads of one row of pad bytes; whole texts of
    any length are stored; equal payloads give equal values, from one stored
    copy (what other tasks stored of it is read by nobody); repeated rows give repeated rows; a null id stays null; other columns
    are ignored. An empty table stores nothing and gives no rows.
    """
    root = root or f"{checkpoint_dir(docs.sparkSession)}/media-{uuid.uuid4().hex}"
    rows, _ = durable(store_texts(docs, root, id_col, text_col), "media-manifest")
    one = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.*")
    # addresses are small and the pictures they name are not: a named number of partitions, which adaptive execution does not coalesce
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((rows.agg(F.sum("length")).first()[0] or 0) / READ_BYTES))
    seen, _ = durable(read_media(one.repartition(tasks, "shard").sortWithinPartitions("shard", "offset"), root), "media-features")
    return rows.select(F.col("id").alias(id_col), "n_bytes", "digest").join(seen, "digest")
