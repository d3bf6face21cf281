"""Documents packed into a bucketed scratch table of chunks.

A chunk is one row: the ids, lengths and compressed bytes of a few thousand
documents. Rounds that send findings about documents to other tasks and get
verdicts back name a document by (chunk, place), and join the verdicts to the
table without shuffling a text, as the table is bucketed by chunk. It lies in
the shared folder, so a lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, remove_path, small_batches

CHUNK_BYTES = 4 << 20
#: Order value of a null id: after every other.
LAST_ID = (1 << 63) - 1
_ZSTD = pa.Codec("zstd", compression_level=1)
SCHEMA = "n_docs int, raw_bytes long, ids binary, nulls binary, lengths binary, body binary"


def squeeze(raw) -> bytes:
    return len(raw).to_bytes(8, "little") + (_ZSTD.compress(raw, asbytes=True) if len(raw) else b"")


def expand(blob: bytes) -> bytes:
    n = int.from_bytes(blob[:8], "little")
    return _ZSTD.decompress(blob[8:], n, asbytes=True) if n else b""


def pack_columns(*arrays: np.ndarray) -> bytes:
    """Arrays of one length each, as byte planes (small and sorted values leave empty planes), compressed plane by plane, so that no second copy of all is held."""
    sizes = [np.array([len(arrays)], "<u4").tobytes()]
    sizes += [np.array([len(a), a.dtype.itemsize], "<u4").tobytes() + a.dtype.str.encode().ljust(8) for a in arrays]
    head = b"".join(sizes)
    stream = zstandard.ZstdCompressor(level=1).compressobj()
    out = [(len(head) + sum(a.nbytes for a in arrays)).to_bytes(8, "little"), stream.compress(head)]
    for a in arrays:
        if len(a):
            planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
            out += [stream.compress(p.tobytes()) for p in planes]
    return b"".join([*out, stream.flush()])


def unpack_columns(blob: bytes) -> list[np.ndarray]:
    """What pack_columns() packed, decompressed plane by plane."""
    stream = zstandard.ZstdDecompressor().stream_reader(memoryview(blob)[8:])
    k = int.from_bytes(stream.read(4), "little")
    heads, out = [stream.read(16) for _ in range(k)], []
    for head in heads:
        n, size = (int(x) for x in np.frombuffer(head, "<u4", 2))
        values = np.empty((n, size), np.uint8)
        for j in range(size if n else 0):
            values[:, j] = np.frombuffer(stream.read(n), np.uint8)
        out.append(values.reshape(-1).view(head[8:].decode().strip()))
    return out


@dataclass
class Chunk:
    """Documents one after another: bytes, where each starts and ends, ids (null: LAST_ID) and which ids are null."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray

    def blocks(self, size: int):
        """(first document, last + 1) of runs of documents of about `size` bytes."""
        at, n = 0, len(self.ids)
        while at < n:
            stop = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + size, side="right")))
            yield at, stop
            at = stop


def open_chunk(ids: bytes, nulls: bytes, lengths: bytes, body: bytes) -> Chunk:
    size = np.frombuffer(lengths, "<i8")
    ends = np.cumsum(size)
    return Chunk(np.frombuffer(expand(body), np.uint8), ends - size, ends, np.frombuffer(ids, "<i8"), np.frombuffer(nulls, np.uint8).astype(bool))


@dataclass
class ChunkTable:
    table: DataFrame
    name: str
    path: str

    def drop(self) -> None:
        spark = self.table.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(spark, self.path)


def chunk_table(df: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> ChunkTable:
    """df's documents (null text: empty) as rows of SCHEMA with a chunk number, bucketed by it."""
    schema = pa.schema([("n_docs", pa.int32()), ("raw_bytes", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("lengths", pa.binary()), ("body", pa.binary())])

    def pack(batches):
        parts: list[tuple] = []
        held = 0

        def out():
            ids, nulls, lengths, raw = (b"".join(p[i] for p in parts) for i in range(4))
            row = [len(lengths) // 8, len(raw), ids, nulls, lengths, squeeze(raw)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

        for batch in batches:
            ids = batch["id"]
            nulls = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
            values = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype("<i8")
            texts = batch["text"].cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
            data = texts.buffers()[2]
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes - held, side="right")) - 1)
                raw = data[int(offsets[at]) : int(offsets[stop])].to_pybytes() if data is not None else b""
                parts.append((values[at:stop].tobytes(), nulls[at:stop].astype(np.uint8).tobytes(), np.diff(offsets[at : stop + 1]).astype("<i8").tobytes(), raw))
                held += len(raw) + 64 * (stop - at)
                at = stop
                if held >= chunk_bytes or at < len(texts):
                    yield out()
                    parts, held = [], 0
        if parts:
            yield out()

    spark = df.sparkSession
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = fresh_path(spark, "chunks"), f"loomline_chunks_{uuid.uuid4().hex}"
    packed = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(pack, SCHEMA)
    with small_batches(spark):
        packed.withColumn("chunk", F.monotonically_increasing_id()).write.bucketBy(n_buckets, "chunk").option("compression", "none").option("path", path).format("parquet").saveAsTable(name)
    return ChunkTable(spark.table(name), name, path)
