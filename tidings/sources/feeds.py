"""Article feeds (S1-S7): nested JSON with an ``articles`` array, one
folder per topic (``topic=<name>/``), flattened with fixed
defaults; price files wide -> long; CSV dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_BYTES = 256 << 20  # of text that one task writes to one feed file

FEED_SCHEMA = T.StructType([
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("description", T.StringType()),
    ]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_feed(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA,
              multi_line: bool = True) -> DataFrame:
    """Feed files under ``path`` (``topic=...`` folders become a
    ``topic`` column); one JSON document per file (``multi_line``) or one
    per line. Malformed records are kept as ``_corrupt_record`` rows
    (see ``failed_files``), not dropped silently."""
    return (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def failed_files(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("_corrupt_record").isNotNull()).select("_file").distinct()


def topic_counts(feed: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Per topic its articles, malformed records and whether it failed."""
    broken = F.col("_corrupt_record").isNotNull()
    return feed.groupBy(F.col(topic_col).alias("topic")).agg(
        F.coalesce(F.sum(F.when(~broken, F.coalesce(F.size("articles"), F.lit(0)))), F.lit(0)).alias("n_articles"),
        F.count_if(broken).alias("n_malformed"), F.max(broken.cast("int")).alias("failed"))


def flatten_articles(feed: DataFrame, topic_col: str = "topic") -> DataFrame:
    """One row per article; absent or NULL title/url/description/
    publishedAt become "", absent or NULL source name becomes "Unknown"."""
    a = feed.where(F.col("_corrupt_record").isNull()).select(
        F.col(topic_col).alias("topic"), F.inline(F.coalesce(F.col("articles"), F.array().cast(
            FEED_SCHEMA["articles"].dataType))))
    return a.select(
        "topic",
        F.coalesce(F.col("title"), F.lit("")).alias("headline"),
        F.coalesce(F.col("source.name"), F.lit("Unknown")).alias("source"),
        F.coalesce(F.col("publishedAt"), F.lit("")).alias("published_at"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"))


def to_feed(news: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Inverse of ``flatten_articles`` for writers and tests: one feed
    record per article (JSON lines), so no group is collected."""
    art = F.struct(F.col("headline").alias("title"), F.struct(F.col("source").alias("name")).alias("source"),
                   F.date_format(F.col("published_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
                   F.col("url").alias("url"), F.col("description").alias("description"))
    return news.select(F.col(topic_col).alias("topic"), F.array(art).alias("articles"))


def in_parts(rows: DataFrame, key: str, text: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """``rows`` with a ``_part``: a key's rows are dealt by a hash into as many
    parts of about ``part_bytes`` of text as they need, so that no key is one
    task's work when it is written."""
    sizes = rows.groupBy(F.col(key).alias("_key")).agg(
        F.greatest(F.ceil(F.sum(F.coalesce(F.octet_length(text), F.lit(0))) / part_bytes), F.lit(1)).alias("_parts"))
    dealt = rows.join(F.broadcast(sizes), F.col(key).eqNullSafe(F.col("_key")))  # a row per key; rows are not shuffled by key
    return dealt.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int")).drop("_key", "_parts")


def part_count(rows: DataFrame, text: str, least: int = 1, part_bytes: int = PART_BYTES) -> int:
    """Parts of about ``part_bytes`` of text that the rows need, ``least`` at least."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, -(-size // part_bytes))


def read_prices_wide(spark: SparkSession, path: str, date_col: str = "Date") -> DataFrame:
    """A wide CSV (date + one column per series) as long rows."""
    wide = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = [c for c in wide.columns if c != date_col]
    return wide.unpivot([date_col], names, "name", "close").select(
        "name", F.to_date(date_col).alias("date"), F.col("close").cast("double").alias("close")) \
        .where(F.col("close").isNotNull())


def read_sector_map(spark: SparkSession, path: str) -> DataFrame:
    """The entity dimension CSV."""
    return spark.read.schema("ticker string, name string, sector string").option("header", True) \
        .option("multiLine", True).option("escape", '"').csv(path)


def union_series(frames: list[DataFrame]) -> DataFrame:
    """Long-form series from several loads."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
