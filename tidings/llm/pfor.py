"""Token ids as binary shards: patched frame-of-reference blocks.

A shard is one file, written by one task and made of frames. A frame holds
whole documents (at least ``FRAME_IDS`` ids, or a single longer document):

    header   magic 'PFR1', bytes of the frame, documents, ids, blocks,
             exceptions (u32 each), first id's place in the shard (u64)
    documents  ids (i64), null marks (u8), number of ids (u32)
    blocks   minimum (u32), width (u8), number of exceptions (u16),
             start of the block in the payload (u32)
    payload  per block BLOCK values of its width, packed
    exceptions  place in the block (u16), bits beyond the width (u32)

All numbers are little-endian. A block stores value - minimum. Its width is
the bit length of the ``PERCENTILE`` residual; the bits of larger residuals
beyond that width go to the exception list. The last block is filled up with
its minimum. The index of block starts gives access to any block.

A shard ends in a footer: shard number, ids (u64 each), frames (u32), magic
'PFRE'. Spark's text writer adds a line feed after each frame and after the
footer; lengths in the headers say where they are, so binary content needs
no escaping. Spark's writer commits files, so lost executors and repeated
tasks leave no partial shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings.llm.vocab import Encoder, path_of
from tidings.session import scratch_path, written

BLOCK = 512
PERCENTILE = 90
FRAME_IDS = 1 << 17
HEAD = struct.Struct("<4sIIIIIQ")
FOOT = struct.Struct("<QQI4s")
MAGIC, END = b"PFR1", b"PFRE"


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _overlaps(w: int) -> list[tuple[int, int, int]]:
    """Eight values of ``w`` bits fill ``w`` bytes, high bits first: (value, byte,
    left shift of the value into the byte) wherever both share bits."""
    return [(j, k, 8 * (k + 1) - (j + 1) * w) for j in range(8) for k in range(j * w // 8, -(-(j + 1) * w // 8))]


def _pack(values: np.ndarray, w: int) -> np.ndarray:
    """(blocks, BLOCK) -> (blocks, bytes): the low ``w`` bits of each value."""
    word = "u4" if w <= 24 else "u8"
    v = values.astype(word, copy=False).reshape(-1, 8) & np.array((1 << w) - 1, word)
    v = np.ascontiguousarray(v.T)
    out = np.zeros((w, v.shape[1]), "u1")
    for j, k, shift in _overlaps(w):
        out[k] |= (v[j] << shift if shift >= 0 else v[j] >> -shift).astype("u1")
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def _unpack(packed: np.ndarray, w: int) -> np.ndarray:
    """The inverse of ``_pack``."""
    word = "u4" if w <= 24 else "u8"
    p = np.ascontiguousarray(packed.reshape(-1, w).T).astype(word)
    out = np.zeros((8, p.shape[1]), word)
    for j, k, shift in _overlaps(w):
        out[j] |= p[k] >> shift if shift >= 0 else p[k] << -shift
    return (out & np.array((1 << w) - 1, word)).T.reshape(len(packed), BLOCK).astype("u4")


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Sections of the blocks of a frame: minimum, width, number of
    exceptions, start, payload, exception places, exception bits."""
    n = -(-len(ids) // BLOCK)
    full = np.full(n * BLOCK, ids[-1] if len(ids) else 0, "u4")
    full[:len(ids)] = ids
    grid = full.reshape(n, BLOCK)
    if n and len(ids) % BLOCK:
        grid[-1, len(ids) % BLOCK:] = grid[-1, :len(ids) % BLOCK].min()
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    at = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    width = _bit_length(np.partition(rest, at, axis=1)[:, at])
    over = rest >> width[:, None].astype("u4") if n else rest
    over[width == 32] = 0
    row, place = np.nonzero(over)
    start = np.concatenate([[0], np.cumsum(width.astype("u8") * (BLOCK // 8))])
    payload = np.zeros(int(start[-1]), "u1")
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            packed = _pack(rest[which], int(w))
            payload[start[which].astype("i8")[:, None] + np.arange(packed.shape[1])] = packed
    return [x.tobytes() for x in (low.astype("<u4"), width, np.bincount(row, minlength=n).astype("<u2"),
                                  start[:-1].astype("<u4"), payload, place.astype("<u2"), over[row, place].astype("<u4"))]


def unpack_blocks(n_ids: int, low, width, n_over, start, payload, place, bits) -> np.ndarray:
    n = len(low)
    grid = np.zeros((n, BLOCK), "u4")
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            packed = payload[start[which].astype("i8")[:, None] + np.arange(int(w) * BLOCK // 8)]
            grid[which] = _unpack(packed, int(w))
    row = np.repeat(np.arange(n), n_over)
    grid[row, place] |= bits << width[row].astype("u4")
    return (grid + low[:, None]).reshape(-1)[:n_ids]


def encode_frame(doc_ids: list, texts_ids: list[bytes], first: int) -> bytes:
    ids = np.frombuffer(b"".join(texts_ids), "<u4")
    low, width, n_over, start, payload, place, bits = pack_blocks(ids)
    body = b"".join([np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
                     bytes(d is None for d in doc_ids), np.array([len(t) // 4 for t in texts_ids], "<u4").tobytes(),
                     low, width, n_over, start, payload, place, bits])
    return HEAD.pack(MAGIC, HEAD.size + len(body), len(doc_ids), len(ids), len(width), len(place) // 2, first) + body


def decode_frame(data: memoryview) -> tuple[list, np.ndarray, np.ndarray, int]:
    """(document ids, ids per document, all ids, first id's place)."""
    magic, size, n_docs, n_ids, n_blocks, n_over, first = HEAD.unpack_from(data)
    if magic != MAGIC or size > len(data):
        raise ValueError("not a frame")
    at = HEAD.size

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(data, kind, n, at)
        at += x.nbytes
        return x
    doc_ids, null, counts = take(n_docs, "<i8"), take(n_docs, "u1"), take(n_docs, "<u4")
    low, width, over, start = take(n_blocks, "<u4"), take(n_blocks, "u1"), take(n_blocks, "<u2"), take(n_blocks, "<u4")
    payload = take(size - at - 6 * n_over, "u1")
    place, bits = take(n_over, "<u2"), take(n_over, "<u4")
    ids = unpack_blocks(n_ids, low, width, over, start, payload, place, bits)
    return [None if z else int(d) for d, z in zip(doc_ids, null)], counts, ids, first


def frames(content: bytes) -> Iterator[memoryview]:
    """The frames of a shard's content, without the footer."""
    data, at = memoryview(content), 0
    while data[at:at + 4] == MAGIC:
        size = HEAD.unpack_from(data, at)[1]
        yield data[at:at + size]
        at += size + 1


def footer(shard: int, n_ids: int, n_frames: int) -> bytes:
    return FOOT.pack(shard, n_ids, n_frames, END)


def documents_of(content: bytes) -> Iterator[pd.DataFrame]:
    """The documents of a shard, frame by frame, checked against its footer."""
    if len(content) <= FOOT.size:
        return
    shard, n_ids, n_frames, end = FOOT.unpack_from(content, len(content) - FOOT.size - 1)
    for frame in frames(content):
        doc_ids, counts, ids, first = decode_frame(frame)
        raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        ends = np.cumsum(counts, dtype="i8")
        starts = ends - counts
        n_ids, n_frames = n_ids - len(ids), n_frames - 1
        yield pd.DataFrame({"shard": shard, "doc_id": pd.array(doc_ids, "Int64"), "start": starts + int(first),
                            "n_tokens": counts.astype("i8"),
                            "ids_crc32": [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends)]})
    if end != END or n_ids or n_frames:
        raise ValueError("a shard is damaged")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> None:
    """Write all documents in ascending id order (null first; equal ids by
    text): shard k holds the ids before those of shard k + 1."""
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def row(frame: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["frame"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(path_of(vocabulary), words=True)
        end = end_id.to_bytes(4, "little")
        doc_ids, held, size, first, n_frames = [], [], 0, 0, 0
        for b in batches:
            for d, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text"))):
                doc_ids.append(d)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= FRAME_IDS:
                    yield row(encode_frame(doc_ids, held, first))
                    first, n_frames = first + size, n_frames + 1
                    doc_ids, held, size = [], [], 0
        if held:
            yield row(encode_frame(doc_ids, held, first))
            first, n_frames = first + size, n_frames + 1
        if n_frames:
            yield row(footer(TaskContext.get().partitionId(), first, n_frames))

    ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string")).write.text(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: shard, doc_id, start in the shard,
    n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                yield from documents_of(content)

    return files.mapInPandas(run, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write the shards into the shared folder, read them back, and return per
    document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32. Null text counts as empty. An empty table gives no rows."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"token-shards-{uuid.uuid4().hex}")
    write_shards(docs, path, id_col, text_col, vocabulary, end_id)
    rows = written(read_shards(spark, path), "token-index")
    order = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_ids")) \
        .select("shard", F.coalesce(F.sum("_ids").over(order), F.lit(0)).alias("_base"))  # one row per shard
    return rows.join(bases, "shard").select("doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids_crc32")
