"""Which keys were ever stored: digests in bucket files, found by Bloom filters
(R2, S9).

Every batch stores the SHA-256 digests of its new keys as one run, cut into
buckets by the digest, with a Bloom filter per bucket. A later batch tests its
digests against the filters; files in which no digest may be are not read, and
the exact anti-join runs against the others. Filters never miss a stored
digest, so the result is exact.

Runs are compacted in tiers: ``FAN`` runs of one level become one run of the
next, so a lookup meets a number of runs that grows with the logarithm of the
batches. A manifest per batch names the live runs; a batch that runs again sees
the manifest before it and writes its own run and manifest anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
FALSE_POSITIVES = 1e-4
FAN = 4

_RUNS = "epoch long, run string, level int"
_FILTERS = "run string, bucket int, bits binary"


def _probes(digests: pd.Series, size: int, hashes: int) -> np.ndarray:
    """Bit positions of each hex digest: two halves of it, combined."""
    raw = np.frombuffer(b"".join(bytes.fromhex(x[:32]) for x in digests), ">u8").reshape(-1, 2).astype(np.uint64)
    with np.errstate(over="ignore"):
        steps = raw[:, :1] + np.arange(hashes, dtype=np.uint64) * (raw[:, 1:] | np.uint64(1))
    return (steps % np.uint64(size)).astype(np.int64)


def bloom(digests: pd.Series, rate: float = FALSE_POSITIVES) -> bytes:
    """A Bloom filter for the digests; its length gives all its parameters."""
    size = max(64, 8 * math.ceil(-len(digests) * math.log(rate) / math.log(2) ** 2 / 8))
    bits = np.zeros(size, bool)
    bits[_probes(digests, size, _hashes(rate)).ravel()] = True
    return np.packbits(bits).tobytes()


def _hashes(rate: float) -> int:
    return max(1, round(-math.log2(rate)))


def may_hold(bits: bytes, digests: pd.Series, rate: float = FALSE_POSITIVES) -> np.ndarray:
    """Which digests may be in the filter's set; all that are in it are."""
    held = np.frombuffer(bits, np.uint8)
    at = _probes(digests, 8 * len(held), _hashes(rate))
    return ((held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


class DigestIndex:
    """The digests stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, rate: float = FALSE_POSITIVES, fan: int = FAN):
        self.spark, self.path, self.buckets, self.rate, self.fan = spark, path, buckets, rate, fan
        # so that the first batch reads what the others read
        spark.createDataFrame([], "run string, level int").write.mode("ignore").parquet(f"{path}/runs/epoch=-1")

    def _bucket(self):
        return F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int")

    def live(self, before: int | None = None) -> list[tuple[str, int]]:
        """(run, level) of the last manifest (of a batch before ``before``)."""
        rows = self.spark.read.schema(_RUNS).parquet(f"{self.path}/runs")
        rows = rows if before is None else rows.where(F.col("epoch") < before)
        last = rows.agg(F.max("epoch")).first()[0]
        return sorted((r.run, r.level) for r in rows.where(F.col("epoch") == last).collect()) if last is not None else []

    def _folders(self, runs: list[str]) -> list[str]:
        return [f"{self.path}/digests/run={r}" for r in runs]

    def candidates(self, digests: DataFrame, before: int | None = None) -> list[str]:
        """Folders (run, bucket) that may hold one of ``digests``: at most live
        runs x buckets names. Filters meet the digests by bucket."""
        runs = [r for r, _ in self.live(before)]
        if not runs:
            return []
        filters = self.spark.read.schema("bucket int, bits binary").option("basePath", f"{self.path}/filters") \
            .parquet(*[f"{self.path}/filters/run={r}" for r in runs])
        filters = filters.withColumn("run", F.regexp_extract(F.input_file_name(), "run=([^/]+)/", 1))
        # a bucket's digests go in blocks: each is tested against the bucket's filters in one row
        asked = digests.select("digest").distinct().withColumn("bucket", self._bucket()) \
            .groupBy("bucket", F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(16)).alias("block")).agg(F.collect_list("digest").alias("digests"))
        rate = self.rate

        @F.pandas_udf("boolean")
        def hits(bits: pd.Series, asked: pd.Series) -> pd.Series:
            return pd.Series([bool(may_hold(b, pd.Series(d), rate).any()) for b, d in zip(bits, asked)])
        found = asked.join(filters, "bucket").where(hits("bits", "digests")).select("run", "bucket").distinct()
        return sorted(f"{self.path}/digests/run={r.run}/bucket={r.bucket}" for r in found.collect())

    def unseen(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """``rows`` (with a ``digest``) whose digest is stored nowhere."""
        folders = self.candidates(rows, before)
        if not folders:
            return rows
        return rows.join(self.spark.read.schema("digest string").parquet(*folders), "digest", "left_anti")

    def add(self, digests: DataFrame, epoch: int) -> None:
        """Stores a batch's new digests and its manifest, compacting full tiers."""
        runs = self.live(epoch)
        self._write(digests.select("digest"), f"{epoch}-0")
        runs.append((f"{epoch}-0", 0))
        level = 0
        while len(full := [r for r, n in runs if n == level]) >= self.fan:
            self._write(self.spark.read.schema("digest string").option("basePath", f"{self.path}/digests")
                        .parquet(*self._folders(full)), f"{epoch}-{level + 1}")
            runs = [(r, n) for r, n in runs if n != level] + [(f"{epoch}-{level + 1}", level + 1)]
            level += 1
        self.spark.createDataFrame(runs, "run string, level int").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.path}/runs/epoch={epoch}")

    def _write(self, digests: DataFrame, run: str) -> None:
        """A run's bucket files and filters. Digests are uniform, so buckets are
        even; the filter is built from the written files of one bucket."""
        rate, folder = self.rate, f"{self.path}/digests/run={run}"
        digests.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "digest") \
            .write.mode("overwrite").partitionBy("bucket").parquet(folder)

        def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict[int, list] = {}
            for b in batches:
                for bucket, part in b.groupby("bucket")["digest"]:
                    held.setdefault(int(bucket), []).append(part)
            for bucket, parts in held.items():
                yield pd.DataFrame({"bucket": [bucket], "bits": [bloom(pd.concat(parts), rate)]})
        stored = self.spark.read.schema("digest string, bucket int").parquet(folder)
        (stored.repartition(self.buckets, "bucket").mapInPandas(build, "bucket int, bits binary")
         .write.mode("overwrite").parquet(f"{self.path}/filters/run={run}"))


def append_unseen(index: DigestIndex, batch: DataFrame, key: str, epoch: int, first) -> DataFrame:
    """The batch's rows to append: a non-empty key, the first row per key
    (``first``), its digest not stored before ``epoch``."""
    digested = batch.where(F.col(key).isNotNull() & (F.length(F.col(key)) > 0)).withColumn("digest", F.sha2(F.col(key), 256))
    return index.unseen(first(digested), epoch)
