"""Table maintenance on Parquet without a transactional format (S8-S16,
W8): append-if-absent, upsert, insert-or-ignore, column patches, schema
evolution, seeding. Each returns the new table content (or the rows to
add) as a DataFrame; writers put it in a new folder (atomic swap by path),
never overwriting the folder being read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in ``order`` (ascending). An aggregate
    (``min_by`` over a struct), so copies of a hot key combine map-side
    instead of meeting in one window."""
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordk).alias("_r")) \
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def append_new(target: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows of ``batch`` to append: non-empty key, first occurrence per
    key within the batch, key not yet in ``target``."""
    valid = batch.where(F.col(key).isNotNull() & (F.length(F.col(key)) > 0))
    first = first_by_key(valid, [key], order)
    return first.join(target.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def ingest_stats(target: DataFrame, batch: DataFrame, key: str, order: list[str],
                 label: str | None = None) -> DataFrame:
    """One row of ingest counters: fetched, skipped (empty key),
    inserted, duplicates, total after insert and (optional) unlabelled."""
    new = append_new(target, batch, key, order)
    b = batch.agg(F.count(F.lit(1)).alias("fetched"),
                  F.count_if(F.col(key).isNull() | (F.length(F.col(key)) == 0)).alias("skipped"))
    n = new.agg(F.count(F.lit(1)).alias("inserted"),
                *([F.count_if(F.col(label).isNull()).alias("_new_unlab")] if label else []))
    t = target.agg(F.count(F.lit(1)).alias("_before"),
                   *([F.count_if(F.col(label).isNull()).alias("_old_unlab")] if label else []))
    row = b.withColumn("_k", F.lit(1)).join(n.withColumn("_k", F.lit(1)), "_k").join(t.withColumn("_k", F.lit(1)), "_k")
    out = row.select("fetched", "skipped", "inserted",
                     (F.col("fetched") - F.col("skipped") - F.col("inserted")).alias("duplicates"),
                     (F.col("_before") + F.col("inserted")).alias("total"),
                     *([(F.col("_old_unlab") + F.col("_new_unlab")).alias("unlabelled")] if label else []))
    return out


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last write wins per key by ``order`` (updates win ties)."""
    t = target.withColumn("_src", F.lit(0))
    u = updates.select(*target.columns).withColumn("_src", F.lit(1))
    both = t.unionByName(u)
    rest = [c for c in target.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.col("_src"))).alias("_r")) \
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*target.columns)


def insert_ignore(target: DataFrame, updates: DataFrame, keys: list[str],
                  order: list[str] | None = None) -> DataFrame:
    """Existing keys win; new keys are added, the first row per key in
    ``order`` (default: the other columns) when a key repeats."""
    new = updates.select(*target.columns).join(target.select(*keys), keys, "left_anti")
    new = first_by_key(new, keys, order or [c for c in target.columns if c not in keys])
    return target.unionByName(new)


def update_columns(target: DataFrame, patch: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Set ``cols`` from ``patch`` where the key matches and the patch
    value is not NULL; other rows and columns unchanged."""
    p = patch.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in cols])
    j = target.join(p, keys, "left")
    return j.select(*[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in target.columns])


def ensure_columns(df: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """Add missing columns with a default (additive evolution)."""
    for name, (dtype, default) in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default).cast(dtype))
    return df


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty table of the given schema."""
    return spark.createDataFrame([], schema)


def seed_defaults(target: DataFrame, keys: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Add a default row for every key of ``keys`` missing in ``target``."""
    missing = keys.select(key).distinct().join(target.select(key), key, "left_anti")
    for c in target.columns:
        if c != key:
            missing = missing.withColumn(c, F.lit(defaults.get(c)).cast(target.schema[c].dataType))
    return target.unionByName(missing.select(*target.columns))


def labeling_template(news: DataFrame) -> DataFrame:
    """The columns a labeller fills, with an empty label column."""
    return news.select("headline", "source", "topic", "published_at", F.lit("").alias("sentiment_label"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table (overwrite the target folder)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
