"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes: h = 2 h + gear[byte], 32 bits, so it
depends on the last 32 bytes only and all its values come from five
vectorised doublings. A chunk ends where masked bits of the hash are zero;
chunking is normalised: before the normal size more bits must be zero, after
it fewer, within a least and a most size. Since boundaries follow content, an
insertion or a cut moves only the chunks that it touches. A fingerprint is
the set of chunk digests, each with its length. Containment of one text in
another is the length of its chunks that the other has, too, as a share of
the length of all its chunks.

A fingerprint is stored as base64 of sorted entries of 8 bytes (48 bits of a
hash of the chunk, then its length), so it grows with the text. Equal texts
have equal fingerprints; null and empty texts have the empty one, which is
contained only in itself (likeness 1).
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import written

LEAST, NORMAL, MOST = 16, 64, 256
#: Zero bits that end a chunk before and after the normal size.
HARD, EASY = 8, 4
SEED = 8


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte."""
    h = _gear()[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear_hashes(np.frombuffer(data, np.uint8))
    easy = np.flatnonzero(h >> np.uint32(32 - EASY) == 0)
    hard = (easy[h[easy] >> np.uint32(32 - HARD) == 0] + 1).tolist()
    easy = (easy + 1).tolist()
    ends, at = [], 0
    while n - at > LEAST:
        middle, last = at + NORMAL, min(n, at + MOST)
        i = bisect_left(hard, at + LEAST)
        if i < len(hard) and hard[i] <= min(middle, last):
            at = hard[i]
        else:
            i = bisect_left(easy, middle)
            at = easy[i] if i < len(easy) and easy[i] <= last else last
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> np.ndarray:
    """Sorted distinct entries: 48 bits of digest, then 16 bits of length."""
    data = text.encode("utf-8", "surrogatepass")
    at, out = 0, set()
    for end in boundaries(data):
        out.add(xxhash.xxh3_64_intdigest(data[at:end]) & ~0xFFFF | (end - at))
        at = end
    return np.array(sorted(out), np.uint64)


def to_string(entries: np.ndarray) -> str:
    return base64.b64encode(entries.astype("<u8").tobytes()).decode()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's chunks, by length, that b has."""
    if not len(a):
        return float(not len(b))
    length = (a & np.uint64(0xFFFF)).astype(np.int64)
    return float(length[np.isin(a, b, assume_unique=True)].sum() / length.sum())


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) characters replaced by as many first ones of the
    following text, or all of it if it is shorter."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint of each document; a map without a shuffle."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_chars": b["text"].str.len(),
                                "fingerprint": [to_string(chunk_set(t)) for t in b["text"]]})

    return slim.mapInPandas(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def with_following(docs: DataFrame, rows_per_range: int = 1000) -> DataFrame:
    """Rows (range, halo, doc_id, text) such that, in order, each document of
    a range is followed by the next one, the last by a halo row that holds
    the first document of the next range (of the first range after the last).

    Ranges are equal shares of the ids by approximate quantiles, found on the
    ids alone; equal ids stay in one range and are ordered by text, null ids
    come first. Texts are shuffled once.
    """
    spark = docs.sparkSession
    n = docs.count()
    ranges = max(1, -(-n // rows_per_range))
    shares = [i / ranges for i in range(1, ranges)]
    edges = sorted(set(docs.stat.approxQuantile("doc_id", shares, 0.2 / ranges))) if shares else []

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy("float64", na_value=-np.inf)).astype("int32"))

    numbered = docs.withColumn("range", number(F.col("doc_id").cast("double")))
    firsts = (docs.select("doc_id").withColumn("range", number(F.col("doc_id").cast("double")))
              .groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id"))["doc_id"].alias("doc_id")))
    order = Window.partitionBy(F.lit(0)).orderBy("range")  # one row per range
    heads = (firsts.withColumn("_before", F.coalesce(
        F.lag("range").over(order),
        F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
        .select(F.col("doc_id").alias("_head"), "_before"))
    halo = (docs.join(written(heads, "range-heads"), F.col("doc_id").eqNullSafe(F.col("_head")))
            .groupBy("doc_id", "_before").agg(F.min("text").alias("text"))
            .select("doc_id", "text", F.col("_before").alias("range"), F.lit(1).alias("halo")))
    return (numbered.select("doc_id", "text", "range", F.lit(0).alias("halo")).unionByName(halo)
            .repartition("range").sortWithinPartitions("range", "halo", "doc_id", "text"))


def compare_following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (containment of its chunks in
    its edited text and in the next document)."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # range, doc_id, text, entries of the row before
        for b in batches:
            rows = []
            for number, halo, doc_id, text in zip(b["range"], b["halo"], b["doc_id"], b["text"]):
                own = chunk_set(text)
                if last and last[0] == number:
                    _, d, t, e = last
                    changed = edited(t, text)
                    other = chunk_set(changed)
                    rows.append((d, len(t), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                                 to_string(e), to_string(other), containment(e, other), containment(e, own)))
                last = None if halo else (number, doc_id, text, own)
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return with_following(slim).mapInPandas(run, (
        f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"))
