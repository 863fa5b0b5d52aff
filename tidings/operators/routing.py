"""News routing (L2 = J11 -> J12 union (J13 - J14)), J15, and the routing
summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators.text import drop_contained, with_matches

ARTICLE_COLS = ["article_id", "headline", "topic", "source", "published_at", "sentiment_label",
                "sentiment_confidence"]
ROUTED_COLS = ARTICLE_COLS + ["ticker", "company_name", "sector", "matched_via"]
INDEX_SECTOR = "Index"


def labeled_news(news: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Articles with a label (the filter reaches the Parquet scan)."""
    return news.where(F.col(label).isNotNull())


def route(news: DataFrame, dim: DataFrame, topic_map: DataFrame, index_ticker: str,
          id_col: str = "id", text_col: str = "headline") -> DataFrame:
    """Route each article to entities.

    - by name: every non-index dictionary name found in ``text_col`` as a
      whole word (first occurrence), names inside a longer match dropped;
    - by topic: the topic's sector fans out to all its members, except
      members already tagged by name; a topic mapped to ``Index`` yields the
      one ``index_ticker`` row; unmapped topics yield nothing.

    Both come from the article's own row, so the article columns are read
    once and shuffled once (by id, to meet the dictionary hits).
    """
    arts = news.select(F.col(id_col).alias("article_id"), *[c for c in ARTICLE_COLS if c != "article_id"],
                       *([text_col] if text_col not in ARTICLE_COLS else []))
    members = dim.where(F.col("sector") != INDEX_SECTOR).select("ticker", "name", "sector")
    # each topic's fan-out targets as one array: the members of its sector,
    # or the one index row
    index_row = dim.where(F.col("ticker") == index_ticker).select("ticker", "name").limit(1) \
        .withColumn("sector", F.lit(INDEX_SECTOR))
    targets = (topic_map.dropDuplicates(["topic"]).join(members.unionByName(index_row), "sector")
               .groupBy("topic").agg(F.collect_list(F.struct("ticker", "name", "sector")).alias("_targets")))
    m = with_matches(arts, "article_id", text_col, members, "name", "_all")
    m = m.withColumn("_named", F.transform(drop_contained(F.col("_all"), "ticker"), lambda x: x["term"])) \
        .join(targets, "topic", "left")
    named = F.transform("_named", lambda x: x.withField("matched_via", F.lit("company_name")))
    tickers = F.transform("_named", lambda x: x["ticker"])
    fan = F.transform(F.filter(F.coalesce("_targets", F.array()), lambda t: ~F.array_contains(tickers, t["ticker"])),
                      lambda t: t.withField("matched_via", F.lit("topic_macro")))
    return (m.select(*ARTICLE_COLS, F.explode(F.concat(named, fan)).alias("_r"))
            .select(*ARTICLE_COLS, F.col("_r.ticker").alias("ticker"), F.col("_r.name").alias("company_name"),
                    F.col("_r.sector").alias("sector"), F.col("_r.matched_via").alias("matched_via")))


def unrouted(news: DataFrame, routed: DataFrame, id_col: str = "id") -> DataFrame:
    """Articles without any routed row."""
    return news.join(routed.select(F.col("article_id").alias(id_col)), id_col, "left_anti")


def routing_summary(routed: DataFrame) -> DataFrame:
    """The three routing breakdowns (by method, by sector, by label) in one
    pass with GROUPING SETS; ``dimension`` names the breakdown."""
    g = routed.groupingSets([["matched_via"], ["sector"], ["sentiment_label"]],
                            "matched_via", "sector", "sentiment_label") \
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("article_id").alias("n_articles"),
             F.grouping_id().alias("_gid"))
    # grouping_id bits (matched_via, sector, sentiment_label): 1 = rolled up
    dim = (F.when(F.col("_gid") == 3, F.lit("matched_via"))
           .when(F.col("_gid") == 5, F.lit("sector")).otherwise(F.lit("sentiment_label")))
    val = (F.when(F.col("_gid") == 3, F.col("matched_via"))
           .when(F.col("_gid") == 5, F.col("sector")).otherwise(F.col("sentiment_label")))
    return g.select(dim.alias("dimension"), val.alias("value"), "n_rows", "n_articles")
