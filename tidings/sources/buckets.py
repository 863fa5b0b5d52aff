"""Keyed tables that are merged bucket by bucket.

A table is cut by the hash of its key into a fixed number of buckets. A merge
reads and rewrites the buckets that its updates fall into and leaves all other
files as they are, so an upsert of k keys touches at most k buckets whatever
the size of the table. New files go to a folder of the commit, and the commit
becomes visible when its manifest (bucket -> commit that wrote it last) is
written: readers never see half a merge, a commit that failed is written again
from the start, and one that succeeded is not applied twice.

One writer at a time. Keys are unique in the table; updates of one merge may
repeat a key, and each operation states which row wins. Null keys are keys.
Choose ``buckets`` so that one holds some 100 MB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.sources.tables import first_by_key, insert_ignore, update_columns, upsert

_MANIFEST = "commit long, bucket int, written long"


@dataclass(frozen=True)
class BucketedTable:
    """Where a table lies and how it is cut; ``schema`` has the key columns."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _folder(self, commit: int) -> str:
        return f"{self.path}/data/commit={commit}"

    def manifest(self, spark: SparkSession, commit: int | None = None) -> dict[int, int]:
        """bucket -> the commit whose folder holds it, as of ``commit`` (the
        last one without it); at most ``buckets`` entries."""
        rows = spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
        if commit is None:
            commit = rows.agg(F.max("commit")).first()[0]
        return {r.bucket: r.written for r in rows.where((F.col("commit") == commit) & (F.col("bucket") >= 0)).collect()}

    def last_commit(self, spark: SparkSession) -> int:
        return spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest").agg(F.max("commit")).first()[0]

    def _read(self, spark: SparkSession, where: dict[int, int]) -> DataFrame:
        paths = [f"{self._folder(c)}/bucket={b}" for b, c in sorted(where.items())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def read(self, spark: SparkSession, commit: int | None = None) -> DataFrame:
        """The table as of a commit (time travel) or the last one."""
        return self._read(spark, self.manifest(spark, commit))

    def _commit(self, spark: SparkSession, rows: DataFrame, commit: int, before: dict[int, int]) -> None:
        """Writes the new buckets, then the manifest that points to them. A
        row of bucket -1 makes the manifest of an empty table readable."""
        (rows.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(self._folder(commit)))
        listed = spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])) \
            .parquet(self._folder(commit)).select("bucket").distinct()
        now = before | {r.bucket: commit for r in listed.collect()}
        entries = [(b, c) for b, c in now.items()] + [(-1, commit)]
        (spark.createDataFrame(entries, "bucket int, written long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/commit={commit}"))

    def create(self, rows: DataFrame) -> None:
        """Commit 0: all rows."""
        self._commit(rows.sparkSession, rows.select(*self.schema.names), 0, {})

    def merge(self, updates: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame],
              commit: int | None = None) -> int:
        """Replaces the buckets that ``updates`` fall into by ``change(their
        rows, updates)``. With a number for the commit, a merge that runs
        again does nothing if it has succeeded before."""
        spark = updates.sparkSession
        last = self.last_commit(spark)
        commit = last + 1 if commit is None else commit
        if commit <= last:
            return last
        before = self.manifest(spark, last)
        touched = {r.bucket for r in updates.select(self._bucket().alias("bucket")).distinct().collect()}
        held = self._read(spark, {b: c for b, c in before.items() if b in touched})
        self._commit(spark, change(held, updates).select(*self.schema.names), commit, before)
        return commit

    def upsert(self, updates: DataFrame, order: str, commit: int | None = None) -> int:
        """The highest ``order`` per key wins, updates win ties."""
        return self.merge(updates, lambda t, u: upsert(t, u, list(self.keys), order), commit)

    def insert_ignore(self, updates: DataFrame, order: list[str] | None = None, commit: int | None = None) -> int:
        """Existing keys win; of a repeated new key the first in ``order``."""
        return self.merge(updates, lambda t, u: insert_ignore(t, u, list(self.keys), order), commit)

    def patch(self, updates: DataFrame, cols: list[str], commit: int | None = None) -> int:
        """Non-null values of ``cols`` replace those of existing keys; of a
        repeated key the smallest patch counts."""
        def change(t: DataFrame, u: DataFrame) -> DataFrame:
            return update_columns(t, first_by_key(u.select(*self.keys, *cols), list(self.keys), cols), list(self.keys), cols)
        return self.merge(updates, change, commit)
