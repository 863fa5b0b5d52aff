"""Domain tables derived from the provided test tables (FIXTURES.md part B).

The test data holds no prices or headlines, so each domain input is derived
from a provided table by a fixed rule. Every function reads whole tables
and returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions.columns import round6
from tidings.session import literal_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense daily OHLCV bars: one per (event_type, UTC day) of ``events``.
    open/close are the values of the first/last event id of the day."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("name"), F.to_date("ts").alias("date"))
            .agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
                 F.count(F.lit(1)).alias("volume")))


def sparse_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse close series with gaps: per (customer nation, order day) the
    total price of the highest order key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("name"), F.to_date("o_orderdate").alias("date"))
            .agg(F.max_by("o_totalprice", "o_orderkey").alias("close")))


def ship_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (supplier nation, ship day) pairs of ``lineitem``: the
    probe side of the as-of queries (one probe per entity and day)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .select(F.col("n_name").alias("name"), F.to_date("l_shipdate").alias("date"))
            .distinct())


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dimension: ticker = nation key, name = nation, sector = region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("ticker"), F.col("n_name").alias("name"),
        F.col("r_name").alias("sector"))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: documents with their human label turned into a sentiment
    label (NULL for documents without one). headline = body = the whole text,
    topic = language, published = 2024-01-01 + (doc_id mod 30) days."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("topic"),
        F.col("text").alias("headline"), F.col("text").alias("body"), "source",
        F.timestamp_add("DAY", F.col("doc_id") % 30, F.lit("2024-01-01 00:00:00").cast("timestamp"))
        .alias("published_at"),
        F.when(F.col("quality").isNull(), F.lit(None)).when((F.col("doc_id") % 3) == 0, "neutral")
        .when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment_label"),
        round6(F.lit(0.5) + (F.col("doc_id") % 50) / 100.0).alias("sentiment_confidence")))


# The stand-in entity dictionary. Words and bigrams that occur
# in the English test documents, nested on purpose ("by the" contains "the",
# "of the" contains "the" and "of"), each given a sector. The index entity
# is the target of index-mapped topics.
ENTITY_TERMS = [
    ("E01", "the", "Alpha"),
    ("E02", "by the", "Alpha"),
    ("E03", "of the", "Beta"),
    ("E04", "of", "Beta"),
    ("E05", "and", "Gamma"),
    ("E06", "with", "Gamma"),
    ("E07", "for the", "Delta"),
    ("E08", "in the", "Delta"),
    ("E09", "this", "Epsilon"),
    ("E10", "from", "Epsilon"),
    ("IDX", "market index", "Index"),
]
INDEX_TICKER, INDEX_NAME = "IDX", "market index"

# Topic (language) -> sector; 'es' is deliberately unmapped.
TOPIC_SECTORS = [("en", "Alpha"), ("fr", "Index"), ("de", "Gamma")]

# Entity ticker -> event type whose daily close is its price.
TICKER_SERIES = [("E01", "click"), ("E02", "view"), ("E03", "purchase"), ("E04", "signup"),
                 ("E05", "error"), ("E06", "click"), ("E07", "view"), ("E08", "purchase"),
                 ("E09", "signup"), ("E10", "error"), ("IDX", "view")]

# Market-wide series -> feature column (the five macro series
# played by the five event types).
MARKET_SERIES = {
    "view": "nifty_market_prior_1d_return",
    "click": "sp500_prior_1d_return",
    "purchase": "crude_oil_prior_1d_return",
    "signup": "usdinr_prior_1d_return",
    "error": "india_vix_prior_1d_return",
}


def entity_dim(spark: SparkSession) -> DataFrame:
    return literal_table(spark, ENTITY_TERMS, "ticker string, name string, sector string")


def topic_map(spark: SparkSession) -> DataFrame:
    return literal_table(spark, TOPIC_SECTORS, "topic string, sector string")


def entity_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close series named by entity name (P1 rename): bars of the mapped
    event type, renamed through ticker -> name."""
    m = literal_table(spark, TICKER_SERIES, "ticker string, series string")
    dim = entity_dim(spark).select("ticker", "name")
    names = m.join(dim, "ticker").select("series", "name")
    b = bars(spark, sf_dir).select(F.col("name").alias("series"), "date", "close")
    return b.join(names, "series").select("name", "date", "close")


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("name", "date", "close")
