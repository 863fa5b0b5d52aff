"""Daily feature rows per (entity, day): A1, J1-J3, J6-J10, F2, L3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.columns import day_of_week, sentiment_sign, to_utc_day
from tidings.operators.asof import market_features, session_returns
from tidings.session import written

SENTIMENT_FEATURES = ["n_headlines", "pct_positive", "pct_negative", "pct_neutral", "avg_confidence",
                      "net_sentiment"]


def daily_sentiment(routed: DataFrame, key: str = "ticker", ts: str = "published_at",
                    label: str = "sentiment_label", conf: str = "sentiment_confidence",
                    carry: list[str] | None = None) -> DataFrame:
    """A1: per (entity, UTC day) headline count, label counts, mean
    confidence, mean signed confidence and label shares. Partial
    aggregation runs map-side, so hot entities collapse before the shuffle.
    ``carry`` columns (functionally dependent on the key) ride along."""
    r = routed.withColumn("date", to_utc_day(F.col(ts))) \
        .withColumn("_w", sentiment_sign(F.col(label)) * F.col(conf))
    agg = r.groupBy(key, "date").agg(
        F.count("headline").alias("n_headlines"),
        F.count_if(F.col(label) == "positive").alias("n_positive"),
        F.count_if(F.col(label) == "negative").alias("n_negative"),
        F.count_if(F.col(label) == "neutral").alias("n_neutral"),
        F.avg(conf).alias("avg_confidence"),
        F.avg("_w").alias("net_sentiment"),
        *[F.min(c).alias(c) for c in (carry or [])])
    n = F.col("n_headlines")
    return (agg.withColumn("pct_positive", F.try_divide(F.col("n_positive"), n))
            .withColumn("pct_negative", F.try_divide(F.col("n_negative"), n))
            .withColumn("pct_neutral", F.try_divide(F.col("n_neutral"), n)))


def build_dataset(routed: DataFrame, prices: DataFrame, dim: DataFrame, market_series: dict[str, str],
                  index_ticker: str, market_prices: DataFrame | None = None, flat: float = 0.3) -> DataFrame:
    """L3: one row per (ticker, date) with sentiment aggregates, sector,
    next-session return and label (by the routed company name), prior
    1/3-day returns (by the dimension's name for the ticker, 0 if unknown),
    the index entity's net sentiment of the same day (0 if none), the
    prior-day return of each market series (0 if absent) and day of week.
    Rows whose next close is not known yet keep a NULL label.
    """
    # one pass over the routed rows: the company name is fixed by the
    # ticker (both routing branches take it from the dimension)
    feats = daily_sentiment(routed, carry=["company_name"])
    dimb = dim.select("ticker", "name", "sector").dropDuplicates(["ticker"])
    # One row per (ticker, day): every later branch reads this table, so it
    # is written once instead of re-running routing once per branch.
    feats = written(feats.join(dimb.select("ticker", "sector"), "ticker", "left"), "daily-sentiment")

    pairs = feats.select("ticker", "company_name", "date")
    pairs = pairs.join(dimb.select("ticker", F.col("name").alias("_dim_name")), "ticker", "left") \
        .withColumn("_mom_name", F.coalesce(F.col("_dim_name"), F.col("ticker")))
    probes = (pairs.select(F.col("company_name").alias("name"), "date")
              .unionByName(pairs.select(F.col("_mom_name").alias("name"), "date")).distinct())
    asof = session_returns(probes, prices, "name", "date", "close", flat)
    asof = written(asof, "session-returns")
    nxt = pairs.join(asof.select(F.col("name").alias("company_name"), "date", "next_session_return", "label"),
                     ["company_name", "date"], "left") \
        .groupBy("ticker", "date").agg(F.max_by("next_session_return", "company_name").alias("next_session_return"),
                                       F.max_by("label", "company_name").alias("label"))
    mom = pairs.select("ticker", "date", "_mom_name").distinct() \
        .join(asof.select(F.col("name").alias("_mom_name"), "date", "prior_1d_return", "prior_3d_return"),
              ["_mom_name", "date"], "left").drop("_mom_name")

    ds = feats.drop("company_name").join(nxt, ["ticker", "date"], "left").join(mom, ["ticker", "date"], "left") \
        .fillna({"prior_1d_return": 0.0, "prior_3d_return": 0.0})

    idx = feats.where(F.col("ticker") == index_ticker).select("date", F.col("net_sentiment").alias("_mns"))
    ds = ds.join(idx, "date", "left") \
        .withColumn("market_net_sentiment", F.coalesce(F.col("_mns"), F.lit(0.0))).drop("_mns")

    mk = market_features(ds.select("date"), market_prices if market_prices is not None else prices,
                         market_series, "date")
    ds = ds.join(mk, "date", "left")
    return ds.withColumn("day_of_week", day_of_week(F.col("date")))
