"""Best-fit packing of token pieces into fixed-length sequences.

Documents are tokenised where they lie, in slices of bounded bytes; only piece headers (id, piece,
start, length, checksum) are shuffled. A document longer than the sequence
length is cut into full pieces; the first piece takes the remainder. Pieces
are dealt by hash to buckets of about ``pieces_per_bucket`` and packed in
hash order by an online best fit with a bounded number of open sequences:

- open sequences are kept by free space, and one integer serves as bitset of
  the free spaces that occur;
- a piece goes to the open sequence with the least free space that holds it
  (lowest set bit at or above its length);
- if none holds it a new one opens, and beyond ``open_bins`` the fullest
  (lowest set bit) closes first.

State is the bitset and one list of sequence numbers per free space, so
memory is bounded by ``open_bins``, whatever the bucket holds. Numbers are
bucket * 2^40 + n and depend on the hash order only, so a recomputed task
gives the same sequences. The number of buckets follows the number of
pieces; each leaves at most ``open_bins`` sequences partly filled.

Null text counts as empty (one piece, the end id). Rows with null or
repeated ids are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.vocab import Encoder, path_of, slices
from tidings.session import written

PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space online best fit over pieces of 1..size units."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open >= self.open_bins:  # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            free, bin_ = self.size, self.opened
            self.opened += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return bin_, self.size - free


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only longer ones are cut, and
    the first piece takes the remainder."""
    first = n % size or size
    return [(0, min(n, first))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
           vocabulary: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.shared(path_of(vocabulary), words=False)
        end = end_id.to_bytes(4, "little")
        for b in (part for batch in batches for part in slices(batch)):
            rows = []
            for i, ids in enumerate(encoder.encode(b.column("text"))):
                ids = memoryview(ids + end)
                for k, (s, n) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((i, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])))
            i, *rest = np.array(rows, "i8").reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(i)), pa.array(rest[0], pa.int32()), *map(pa.array, rest[1:])],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return slim.mapInArrow(run, PIECE.format(id=slim.schema["doc_id"].dataType.simpleString()))


def pack(pieces: DataFrame, size: int = 1024, open_bins: int = 2048, pieces_per_bucket: int = 100_000) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces."""
    buckets = max(1, -(-pieces.count() // pieces_per_bucket))
    keyed = (pieces.withColumn("_key", F.xxhash64("doc_id", "piece", "ids_crc32"))
             .withColumn("_bucket", F.pmod("_key", F.lit(buckets)))
             .repartition(buckets, "_bucket").sortWithinPartitions("_bucket", "_key", "doc_id", "piece", "start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, fit = None, None
        for b in batches:
            placed = []
            for k, n in zip(b["_bucket"], b["length"]):
                if k != bucket:
                    bucket, fit = k, BestFit(size, open_bins)
                seq, at = fit.place(int(n))
                placed.append(((int(bucket) << 40) + seq, at))
            out = b.drop(columns=["_bucket", "_key"])
            out[["sequence_id", "offset"]] = pd.DataFrame(placed, index=out.index, dtype="int64")
            yield out

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return keyed.mapInPandas(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1024,
                   open_bins: int = 2048, pieces_per_bucket: int = 100_000,
                   vocabulary: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    cut_up = written(pieces(docs, id_col, text_col, size, vocabulary, end_id), "pack-pieces")
    return pack(cut_up, size, open_bins, pieces_per_bucket)
