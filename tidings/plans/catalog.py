"""

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
Dates leave as ISO text and doubles rounded to 6 places so results compare
exactly with the SQL oracle in ``tidings.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.columns import round6
from tidings.operators import asof
from tidings.sources import standins as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def rounded(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- as-of

@query("asof_returns")
def q_asof_returns(spark, sf_dir):
    """Every (supplier nation, ship day) probe, as-of the sparse nation
    close series: baseline, next close, next-session return and label,
    prior 1/3-step returns."""
    r = asof.session_returns(st.ship_probes(spark, sf_dir), st.sparse_prices(spark, sf_dir))
    out = r.select("name", iso(F.col("date")).alias("date"), "close", "next_close",
                   "next_session_return", "label", "prior_1d_return", "prior_3d_return")
    return rounded(out, {"close", "next_close", "next_session_return", "prior_1d_return", "prior_3d_return"})


@query("label_counts")
def q_label_counts(spark, sf_dir):
    """Direction label counts per entity over all probes (flagship)."""
    r = asof.session_returns(st.ship_probes(spark, sf_dir), st.sparse_prices(spark, sf_dir))
    return (r.groupBy("name", F.coalesce("label", F.lit("UNRESOLVED")).alias("label"))
            .agg(F.count(F.lit(1)).alias("n_probes"),
                 round6(F.avg("next_session_return")).alias("avg_return")))


@query("asof_forward_strict")
def q_asof_forward(spark, sf_dir):
    """J7 on its own: first close strictly after each probe day."""
    probes = st.ship_probes(spark, sf_dir)
    prices = st.sparse_prices(spark, sf_dir).withColumnRenamed("date", "price_date")
    prices = prices.withColumn("price_day", F.col("price_date"))
    r = asof.asof_join(probes, prices, "name", "date", "price_date", ["close", "price_day"],
                       direction="forward", allow_exact=False)
    return rounded(r.select("name", iso(F.col("date")).alias("date"),
                            iso(F.col("price_day")).alias("next_date"), F.col("close").alias("next_close")),
                   {"next_close"})


# ---------------------------------------------------------------- series

from tidings.operators import series as ser  # noqa: E402


def _market_series(spark, sf_dir):
    """Whole-market close: total price of the highest order key per day."""
    o = st.table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("close")).withColumn("name", F.lit("MARKET"))


@query("series_returns")
def q_series_returns(spark, sf_dir):
    r = ser.returns(st.sparse_prices(spark, sf_dir))
    return rounded(r.select("name", iso(F.col("date")).alias("date"), "ret"), {"ret"})


@query("calendar_returns")
def q_calendar_returns(spark, sf_dir):
    r = ser.returns(st.sparse_prices(spark, sf_dir), fill="none")
    return rounded(r.select("name", iso(F.col("date")).alias("date"), "ret"), {"ret"})


@query("rolling_volatility")
def q_rolling(spark, sf_dir):
    r = ser.rolling(ser.returns(st.sparse_prices(spark, sf_dir)), "name", "date", "ret", n=90, block=256)
    return r.select("name", iso(F.col("date")).alias("date"), F.round("rolling_std", 3).alias("rolling_std"))


@query("indexed_performance")
def q_indexed(spark, sf_dir):
    r = ser.normalize_base(st.bars(spark, sf_dir))
    return rounded(r.select("name", iso(F.col("date")).alias("date"), "indexed"), {"indexed"})


@query("final_performance")
def q_final_perf(spark, sf_dir):
    return ser.final_performance(st.bars(spark, sf_dir))


@query("latest_change")
def q_latest_change(spark, sf_dir):
    r = ser.latest_change(st.sparse_prices(spark, sf_dir))
    return rounded(r.withColumn("last_date", iso(F.col("last_date"))), {"last_value", "prev_value", "change_pct"})


@query("describe_returns")
def q_describe(spark, sf_dir):
    return ser.describe(ser.returns(st.bars(spark, sf_dir)), "name", "ret")


@query("noise_share")
def q_noise(spark, sf_dir):
    return ser.noise_share(ser.returns(st.bars(spark, sf_dir)), "name", "ret")


@query("sector_volatility")
def q_sector_vol(spark, sf_dir):
    r = ser.sector_volatility(ser.returns(st.sparse_prices(spark, sf_dir)), st.nation_dim(spark, sf_dir))
    return rounded(r, {"avg_volatility"})


@query("sector_returns")
def q_sector_returns(spark, sf_dir):
    r = ser.sector_returns(ser.returns(st.sparse_prices(spark, sf_dir)), st.nation_dim(spark, sf_dir))
    return rounded(r.withColumn("date", iso(F.col("date"))), {"sector_ret"})


@query("sector_market_corr")
def q_sector_corr(spark, sf_dir):
    sec = ser.sector_returns(ser.returns(st.sparse_prices(spark, sf_dir)), st.nation_dim(spark, sf_dir))
    mkt = ser.returns(_market_series(spark, sf_dir))
    return rounded(ser.corr_with(sec, mkt, "sector", "date", "sector_ret", "ret"), {"corr"})


@query("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    r = ser.corr_matrix(ser.returns(st.sparse_prices(spark, sf_dir)))
    return rounded(r, {"corr"})


@query("return_histogram")
def q_histogram(spark, sf_dir):
    r = ser.histogram(ser.returns(st.sparse_prices(spark, sf_dir)), "ret", 80)
    return rounded(r, {"lower", "upper"})


@query("series_coverage")
def q_coverage(spark, sf_dir):
    r = ser.coverage(st.sparse_prices(spark, sf_dir), "name", "date", "close")
    return r.withColumn("first_date", iso(F.col("first_date"))).withColumn("last_date", iso(F.col("last_date")))


@query("overlay_series")
def q_overlay(spark, sf_dir):
    o = st.table(spark, sf_dir, "orders")
    c = st.table(spark, sf_dir, "customer")
    n = st.table(spark, sf_dir, "nation")
    fresh = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
             .groupBy(F.col("n_name").alias("name"), F.date_add(F.to_date("o_orderdate"), 1).alias("date"))
             .agg(F.min_by("o_totalprice", "o_orderkey").alias("close")))
    r = ser.overlay(st.sparse_prices(spark, sf_dir), fresh, ["name", "date"], "close")
    return rounded(r.withColumn("date", iso(F.col("date"))), {"close"})


# ---------------------------------------------------------------- text: rules, matching, routing

from tidings.operators import routing as rt  # noqa: E402
from tidings.operators import text as tx  # noqa: E402


def _news(spark, sf_dir):
    return st.news(spark, sf_dir)


def _routed(spark, sf_dir):
    news = rt.labeled_news(_news(spark, sf_dir))
    return rt.route(news, st.entity_dim(spark), st.topic_map(spark), st.INDEX_TICKER, "id", "body")


@query("label_rules")
def q_label_rules(spark, sf_dir):
    """L1 on whole article bodies: corrected label, original, rule fired."""
    r = tx.apply_label_rules(_news(spark, sf_dir), text="body")
    return r.select("id", "sentiment_label_original", "sentiment_label", "rule")


@query("rule_counts")
def q_rule_counts(spark, sf_dir):
    """Corrections per rule."""
    r = tx.correction_log(tx.apply_label_rules(_news(spark, sf_dir), text="body"))
    return r.groupBy("rule", "original_label", "corrected_label").agg(F.count(F.lit(1)).alias("n"))


@query("term_matches")
def q_term_matches(spark, sf_dir):
    """J11 + J12: dictionary names in article bodies, contained names dropped."""
    members = st.entity_dim(spark).where(F.col("sector") != "Index")
    m = tx.match_terms(_news(spark, sf_dir).select("id", "body"), "id", "body", members)
    m = tx.suppress_contained(m, "id", "ticker")
    return m.select(F.col("id").alias("article_id"), "ticker", "start", "end")


@query("routed_events")
def q_routed(spark, sf_dir):
    """L2: routed (article, entity) rows."""
    r = _routed(spark, sf_dir)
    return r.withColumn("published_at", iso(F.col("published_at"))) \
        .withColumn("sentiment_confidence", round6(F.col("sentiment_confidence")))


@query("routing_summary")
def q_routing_summary(spark, sf_dir):
    return rt.routing_summary(_routed(spark, sf_dir))


@query("unrouted_articles")
def q_unrouted(spark, sf_dir):
    """Labelled articles that no branch routed."""
    news = rt.labeled_news(_news(spark, sf_dir))
    return rt.unrouted(news, _routed(spark, sf_dir)).select("id", "topic", "source")


# ---------------------------------------------------------------- features (A1, L3)

from tidings.operators import features as fe  # noqa: E402

FEATURE_COLS = ["ticker", "date", "n_headlines", "n_positive", "n_negative", "n_neutral", "avg_confidence",
                "net_sentiment", "pct_positive", "pct_negative", "pct_neutral", "sector", "next_session_return",
                "label", "prior_1d_return", "prior_3d_return", "market_net_sentiment"] + \
    list(st.MARKET_SERIES.values()) + ["day_of_week"]
FEATURE_DOUBLES = {"avg_confidence", "net_sentiment", "pct_positive", "pct_negative", "pct_neutral",
                   "next_session_return", "prior_1d_return", "prior_3d_return", "market_net_sentiment"} | \
    set(st.MARKET_SERIES.values())


def _dataset(spark, sf_dir):
    return fe.build_dataset(_routed(spark, sf_dir), st.entity_prices(spark, sf_dir), st.entity_dim(spark),
                            st.MARKET_SERIES, st.INDEX_TICKER, st.market_prices(spark, sf_dir))


@query("daily_sentiment")
def q_daily_sentiment(spark, sf_dir):
    d = fe.daily_sentiment(_routed(spark, sf_dir))
    return rounded(d.withColumn("date", iso(F.col("date"))),
                   {"avg_confidence", "net_sentiment", "pct_positive", "pct_negative", "pct_neutral"})


@query("daily_features")
def q_daily_features(spark, sf_dir):
    """L3: the model's feature table (flagship of the feature stage)."""
    d = _dataset(spark, sf_dir).select(*FEATURE_COLS)
    return rounded(d.withColumn("date", iso(F.col("date"))), FEATURE_DOUBLES)


# ---------------------------------------------------------------- evaluation

from tidings.functions.columns import label_from_return  # noqa: E402
from tidings.operators import evaluate as ev  # noqa: E402


def _predictions(spark, sf_dir):
    """Resolved as-of probes with a momentum forecast as the prediction:
    predicted = direction of the prior 1-step return."""
    r = asof.session_returns(st.ship_probes(spark, sf_dir), st.sparse_prices(spark, sf_dir))
    return r.where(F.col("label").isNotNull() & F.col("prior_1d_return").isNotNull()) \
        .withColumn("predicted_label", label_from_return(F.col("prior_1d_return")))


@query("prediction_agreement")
def q_agreement(spark, sf_dir):
    return rounded(ev.agreement(_predictions(spark, sf_dir), "label", "predicted_label"), {"accuracy"})


@query("confusion_matrix")
def q_confusion(spark, sf_dir):
    return ev.confusion_matrix(_predictions(spark, sf_dir), "label", "predicted_label")


@query("classification_report")
def q_class_report(spark, sf_dir):
    return rounded(ev.classification_report(_predictions(spark, sf_dir), "label", "predicted_label"),
                   {"precision", "recall", "f1"})


@query("run_metrics")
def q_run_metrics(spark, sf_dir):
    """Time split, model (momentum forecast) accuracy on the test
    part, majority baseline from the train part, lift in points."""
    p = ev.time_split(_predictions(spark, sf_dir), "date")
    train, test = p.where(F.col("part") == "train"), p.where(F.col("part") == "test")
    base = ev.majority_baseline(train, test, "label")
    model = test.agg(F.avg((F.col("label") == F.col("predicted_label")).cast("int")).alias("model_accuracy"))
    counts = p.agg(F.count(F.lit(1)).alias("n_labeled_rows"), F.count_distinct("date").alias("n_dates"),
                   F.count_if(F.col("part") == "train").alias("train_rows"),
                   F.count_if(F.col("part") == "test").alias("test_rows"),
                   F.min(F.when(F.col("part") == "test", F.col("date"))).alias("split_date"))
    m = model.first()["model_accuracy"]
    b = base.first()
    return rounded(counts.withColumn("split_date", iso(F.col("split_date")))
                   .withColumn("model_accuracy", F.lit(m).cast("double"))
                   .withColumn("baseline_accuracy", F.lit(b["baseline_accuracy"]).cast("double"))
                   .withColumn("majority_label", F.lit(b["majority_label"]))
                   .withColumn("lift_pts", (F.col("model_accuracy") - F.col("baseline_accuracy")) * 100),
                   {"model_accuracy", "baseline_accuracy", "lift_pts"})


def _human_labels(spark, sf_dir):
    return st.table(spark, sf_dir, "labels")


@query("class_weights")
def q_class_weights(spark, sf_dir):
    return rounded(ev.class_weights(_human_labels(spark, sf_dir), "quality"), {"weight"})


@query("stratified_folds")
def q_folds(spark, sf_dir):
    f = ev.stratified_folds(_human_labels(spark, sf_dir), "doc_id", "quality", 5, 42)
    return f.groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n"))


@query("fold_summary")
def q_fold_summary(spark, sf_dir):
    """Per-fold agreement of quality with non-toxicity, mean and
    population std over the 5 folds."""
    f = ev.stratified_folds(_human_labels(spark, sf_dir), "doc_id", "quality", 5, 42)
    per = f.groupBy("fold").agg(F.avg((F.col("quality") == 1 - F.col("toxic")).cast("int")).alias("accuracy"))
    return rounded(ev.fold_summary(per), {"mean", "std"})


@query("holdout_split")
def q_holdout(spark, sf_dir):
    h = ev.holdout(st.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 0.2, 42)
    return h.groupBy("holdout", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("training_guard")
def q_guard(spark, sf_dir):
    return ev.training_guard(_dataset(spark, sf_dir), "label", 40)


# ---------------------------------------------------------------- learning loop

from tidings.operators import learning as lr  # noqa: E402

SIGNAL_KEYS = ["name", "signal"]


def _signal_outcomes(spark, sf_dir):
    """Per (entity, judged signal, day) outcomes of the momentum forecast.
    The judged signal follows from the two momentum horizons; ``sector`` and
    NULL are judged, too, and must be skipped by the weights."""
    p = _predictions(spark, sf_dir)
    one, three = F.col("prior_1d_return"), F.coalesce("prior_3d_return", F.lit(0.0))
    sig = (F.when(F.abs(one) >= F.abs(three), F.when(one > 0, "stock_momentum").otherwise("nifty_momentum"))
           .when(three > 20, F.lit(None).cast("string")).when(three > 0, "sector").otherwise("market_sentiment"))
    return p.select("name", sig.alias("signal"), "date",
                    (F.col("label") == F.col("predicted_label")).cast("int").alias("correct"))


def _stored_weights(spark, sf_dir):
    """A stored state of the stock momentum signal for every second nation,
    and of a signal without outcomes for every fifth."""
    n = st.table(spark, sf_dir, "nation")

    def rows(every: int, signal: str, *state) -> DataFrame:
        return n.where(F.col("n_nationkey") % every == 0).select(
            F.col("n_name").alias("name"), F.lit(signal).alias("signal"),
            *[F.lit(x).cast(t).alias(c) for (c, f), x, t in zip(lr.STORED_STATE.items(), state,
                                                              ["double", "int", "int", "int", "int", "double"])])
    return rows(2, "stock_momentum", 0.7, 1, 0, 2, 3, 1.4).unionByName(rows(5, "day_of_week", 1.3, 2, 0, 4, 0, None))


@query("signal_weights")
def q_signal_weights(spark, sf_dir):
    """Final weight state per (entity, signal), from the stored state."""
    s = lr.adjust_weights(_signal_outcomes(spark, sf_dir), SIGNAL_KEYS, with_log=False,
                          stored=_stored_weights(spark, sf_dir))
    return rounded(s.drop("log"), {"current_weight", "pre_decay_weight", "drift"})


@query("weight_changes")
def q_weight_changes(spark, sf_dir):
    """L6 change log: every weight change (decay, restore, -10 %, +10 %)."""
    s = lr.adjust_weights(_signal_outcomes(spark, sf_dir), SIGNAL_KEYS, stored=_stored_weights(spark, sf_dir))
    w = lr.weight_changes(s, SIGNAL_KEYS)
    return rounded(w.withColumn("date", iso(F.col("date"))), {"weight_before", "weight_after"})


@query("outcome_streaks")
def q_streaks(spark, sf_dir):
    """Current run length of right/wrong outcomes per entity and day."""
    o = _signal_outcomes(spark, sf_dir)
    s = lr.streaks(o, ["name"], "date", "correct")
    return s.select("name", iso(F.col("date")).alias("date"), "correct", "streak")


INDEX_SERIES = "view"


def _index_log(spark, sf_dir):
    """Prediction log of the index series (bars of one event type): the
    prediction for the next session is the direction of the prior-day
    return; top signals are the three market series with the largest
    prior-day moves; the precedent similarity is |prior 3-day move| / 10,
    capped at 1."""
    bars = st.market_prices(spark, sf_dir)
    idx = bars.where(F.col("name") == INDEX_SERIES)
    r = asof.session_returns(idx.select("name", "date"), idx)
    mk = asof.market_features(idx.select("date"), bars, st.MARKET_SERIES, "date")
    sig_names = {c: s for s, cols in lr.SIGNAL_FEATURES.items() for c in cols if c in st.MARKET_SERIES.values()}
    items = F.array(*[F.struct(F.lit(n).alias("signal"), F.col(c).alias("contribution"))
                      for c, n in sig_names.items()])
    top = F.slice(F.array_sort(items, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1)
                               .when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1)
                               .when(a["signal"] < b["signal"], -1).when(a["signal"] > b["signal"], 1)
                               .otherwise(0)), 1, 3)
    sim = F.when(F.col("prior_3d_return").isNotNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("headline"), F.lit(None).cast("string").alias("date"),
        F.round(F.least(F.abs("prior_3d_return") / 10, F.lit(1.0)), 3).alias("similarity"),
        F.lit(None).cast("double").alias("next_session_return"), F.lit(None).cast("string").alias("outcome"))))\
        .otherwise(F.array().cast("array<struct<headline:string,date:string,similarity:double,"
                                  "next_session_return:double,outcome:string>>"))
    log = r.join(mk, "date").select(
        F.date_add("date", 1).alias("date"), label_from_return(F.col("prior_1d_return")).alias("prediction"),
        top.alias("top_signals"), sim.alias("similar"), F.col("date").alias("news_date"))
    actual = r.select(F.col("date").alias("news_date"), F.col("next_session_return").alias("actual_pct_change"))
    return log.where(F.col("prediction").isNotNull()), actual


def _index_outcomes(spark, sf_dir):
    log, actual = _index_log(spark, sf_dir)
    first_week = log.where(F.col("news_date") < F.lit("2024-01-05").cast("date")).select("date")
    return lr.resolve_outcomes(log, first_week, actual)


@query("resolved_outcomes")
def q_resolved(spark, sf_dir):
    """Outcomes of the index predictions not resolved before."""
    o = _index_outcomes(spark, sf_dir)
    return rounded(o.withColumn("date", iso(F.col("date"))).withColumn("news_date", iso(F.col("news_date"))),
                   {"actual_pct_change", "error_magnitude"})


@query("source_credibility")
def q_sources(spark, sf_dir):
    """Running credibility of news sources routed to the index."""
    c = lr.source_credibility(_index_outcomes(spark, sf_dir), _routed(spark, sf_dir), st.INDEX_TICKER)
    return rounded(c.withColumn("date", iso(F.col("date"))), {"accuracy_rate", "current_weight"})


LAST_RETRAIN = "2024-01-15"


@query("retrain_trigger")
def q_retrain(spark, sf_dir):
    """L4 + A28: trigger check from the labelled-headline count, the drift of
    the index signal weights since the last retrain and the last 10 index
    outcomes."""
    outcomes = _index_outcomes(spark, sf_dir)
    state = lr.adjust_weights(outcomes.withColumnRenamed("judged_signal", "signal"), ["signal"])
    drift = lr.drift_since(state, ["signal"], LAST_RETRAIN) \
        .withColumn("last_retrain_headline_count", F.lit(0).cast("long"))
    labeled = rt.labeled_news(_news(spark, sf_dir)).agg(F.count(F.lit(1)).alias("total_labeled"))
    recent = lr.last_n_accuracy(outcomes, 10)
    return rounded(lr.retrain_trigger(drift, labeled, recent), {"cumulative_weight_drift", "last_n_accuracy"})


# Forward-signal rules on the stand-in market series
# (reference: crude > 2 -> Aviation (no members), S&P < -1 -> IT,
# gold > 1 -> FMCG and Pharma, |USD/INR| > 0.5 -> IT).
FORWARD_RULES = [
    ("crude_oil_spike", "purchase", ">", 2.0, ["Aviation"], 5.0),
    ("us_markets_fell", "click", "<", -1.0, ["Beta"], 3.0),
    ("risk_off_gold", "error", ">", 1.0, ["Gamma", "Delta"], 3.0),
    ("usdinr_move", "signup", "abs>", 0.5, ["Beta"], 1.5),
]
WATCH_TOPIC, WATCH_SECTOR = "de", "Gamma"


def _forward(spark, sf_dir, bars):
    """The watch list as of the last day of ``bars``, for the day after."""
    ch = ser.latest_change(bars).select(F.col("name").alias("series"), "change_pct", "last_date")
    rules = spark.createDataFrame(FORWARD_RULES, lr.FORWARD_RULE_SCHEMA)
    last_day = bars.agg(F.max("date").alias("d"))
    topic = rt.labeled_news(_news(spark, sf_dir)).where(F.col("topic") == WATCH_TOPIC) \
        .withColumn("d", F.to_date("published_at")).join(last_day, "d", "left_semi").select("headline")
    f = lr.forward_signals(ch, rules, st.entity_dim(spark), topic, WATCH_SECTOR)
    return f.withColumn("date", F.date_add(last_day.select("d").scalar(), 1))


@query("forward_signals")
def q_forward(spark, sf_dir):
    """Watch-list rows from the latest moves of the market series and the
    watched topic's headlines on the last price date, upserted into those of
    a week before; that day's are computed again and replace themselves."""
    bars = st.market_prices(spark, sf_dir)
    week = F.date_sub(bars.agg(F.max("date")).scalar(), 7)
    before = _forward(spark, sf_dir, bars.where(F.col("date") <= week))
    stored = lr.upsert_signals(before.withColumn("confidence", F.lit(0.0)), before)
    f = lr.upsert_signals(stored, _forward(spark, sf_dir, bars))
    return rounded(f.withColumn("date", iso(F.col("date"))), {"confidence"})


# ---------------------------------------------------------------- similarity

from tidings.operators import similarity as sim  # noqa: E402


@query("tfidf_vocabulary")
def q_vocab(spark, sf_dir):
    """M5: vocabulary (top 2000 terms by corpus frequency) and smoothed idf
    over all document texts."""
    d = st.table(spark, sf_dir, "documents")
    v = sim.vocabulary(d, "text")
    return rounded(v, {"idf"})


@query("similar_documents")
def q_similar(spark, sf_dir):
    """M6 + M7: the 3 documents most similar to any benchmark passage, with
    the index's next-session return after the document's day."""
    d = st.table(spark, sf_dir, "documents")
    b = st.table(spark, sf_dir, "benchmark")
    top = sim.similar_docs(b, d, "item_id", "text", "doc_id", "text")
    news = _news(spark, sf_dir).select(F.col("id").alias("doc_id"), F.to_date("published_at").alias("date"))
    top = top.join(news, "doc_id")
    idx = st.market_prices(spark, sf_dir).where(F.col("name") == INDEX_SERIES)
    r = asof.session_returns(top.select(F.lit(INDEX_SERIES).alias("name"), "date"), idx)
    out = top.join(r.select("date", "next_session_return", "label"), "date", "left")
    return rounded(out.select("doc_id", "similarity", "rank", iso(F.col("date")).alias("date"),
                              F.round("next_session_return", 2).alias("next_session_return"),
                              F.coalesce("label", F.lit("unresolved")).alias("outcome")), {"similarity"})


@query("similar_per_query")
def q_similar_per_query(spark, sf_dir):
    """The 3 most similar documents for each benchmark passage."""
    d = st.table(spark, sf_dir, "documents")
    b = st.table(spark, sf_dir, "benchmark")
    r = sim.similar_per_query(b, d, "item_id", "text", "doc_id", "text")
    return rounded(r, {"similarity"})


# ---------------------------------------------------------------- ingest and table maintenance

import uuid  # noqa: E402

from tidings.session import cut_lineage, literal_table, scratch_path, written  # noqa: E402
from tidings.sources import feeds as fd  # noqa: E402
from tidings.sources import tables as tb  # noqa: E402
from tidings.sources.buckets import BucketedTable  # noqa: E402


@query("feed_roundtrip")
def q_feed(spark, sf_dir):
    """Articles written as JSON feeds (one folder per topic) into the
    shared scratch folder, read back and flattened."""
    news = _news(spark, sf_dir).select("topic", "headline", "source", "published_at",
                                       F.lit(None).cast("string").alias("url"),
                                       F.lit(None).cast("string").alias("description"))
    path = scratch_path(spark, f"feed-{uuid.uuid4().hex}")
    fd.to_feed(news).write.mode("overwrite").partitionBy("topic").json(path)
    flat = fd.flatten_articles(fd.read_feed(spark, path, multi_line=False))
    return flat.select("topic", "headline", "source", "published_at", "url")


def _stored_and_batch(spark, sf_dir):
    news = _news(spark, sf_dir)
    return news.where(F.col("topic") == "en"), news


@query("dedup_append")
def q_dedup_append(spark, sf_dir):
    """Articles of the incoming batch (all) to add to the stored table
    (English articles): first copy per whole text, text not stored yet."""
    stored, batch = _stored_and_batch(spark, sf_dir)
    new = tb.append_new(stored, batch, "body", ["id"])
    return new.select("id", "topic", "source")


@query("ingest_stats")
def q_ingest_stats(spark, sf_dir):
    stored, batch = _stored_and_batch(spark, sf_dir)
    return tb.ingest_stats(stored, batch, "body", ["id"])


@query("first_copy")
def q_first_copy(spark, sf_dir):
    """The first document (by id) of every distinct text."""
    d = st.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return tb.first_by_key(d, ["text"], ["doc_id"]).select("doc_id", "lang", "source")


def _label_versions(spark, sf_dir):
    target = st.table(spark, sf_dir, "labels").withColumn("version", F.lit(0))
    d = st.table(spark, sf_dir, "documents")
    updates = d.select("doc_id", (F.col("n_chars") > 2000).cast("int").alias("quality"),
                       F.lit(0).alias("toxic"), F.lit(1).alias("version"))
    return target, updates


def _label_table(spark, sf_dir):
    """The labels as a bucketed table in the scratch folder, and the updates."""
    t, u = _label_versions(spark, sf_dir)
    table = BucketedTable(_scratch(spark, "labels"), t.schema, ("doc_id",), 16)
    table.create(t)
    return table, u


@query("upsert_labels")
def q_upsert(spark, sf_dir):
    """Label table after an upsert (last version wins per doc)."""
    table, u = _label_table(spark, sf_dir)
    table.upsert(u, "version")
    return table.read(spark)


@query("insert_ignore_labels")
def q_insert_ignore(spark, sf_dir):
    """Existing labels win, new docs are added."""
    table, u = _label_table(spark, sf_dir)
    table.insert_ignore(u)
    return table.read(spark)


@query("patch_labels")
def q_patch(spark, sf_dir):
    """Quality patched where a patch row exists."""
    table, u = _label_table(spark, sf_dir)
    table.patch(u, ["quality"])
    return table.read(spark)


@query("seed_signal_weights")
def q_seed(spark, sf_dir):
    """S14 + S15: default weight rows for every judged signal seen."""
    empty = tb.empty_table(spark, "signal_name string, current_weight double, consecutive_wrong int, "
                                  "pre_decay_weight double")
    keys = _signal_outcomes(spark, sf_dir).select(F.col("signal").alias("signal_name"))
    return tb.seed_defaults(empty, keys, "signal_name", {"current_weight": 1.0, "consecutive_wrong": 0})


# ---------------------------------------------------------------- views

from tidings.operators import views as vw  # noqa: E402

LABEL_ORDER = ["positive", "neutral", "negative"]


@query("sentiment_by_day")
def q_sent_by_day(spark, sf_dir):
    """Routed rows per UTC day and label, zeros filled."""
    r = _routed(spark, sf_dir).withColumn("day", iso(F.to_date("published_at")))
    return vw.daily_counts(r, "day", "sentiment_label", LABEL_ORDER)


@query("sector_sentiment")
def q_sector_sentiment(spark, sf_dir):
    return rounded(vw.sector_sentiment(_routed(spark, sf_dir)), {"mean_sign"})


@query("top_sources")
def q_top_sources(spark, sf_dir):
    """O3: the 10 sources with most routed rows."""
    return vw.top_n(_routed(spark, sf_dir), "source", 10)


@query("latest_events")
def q_latest_events(spark, sf_dir):
    """The 50 latest routed events."""
    r = vw.latest(_routed(spark, sf_dir), [F.col("published_at").desc(), F.col("article_id").desc(),
                                           F.col("ticker").asc()], 50)
    return r.select("article_id", "ticker", iso(F.col("published_at")).alias("published_at"), "matched_via")


@query("label_frequency")
def q_label_freq(spark, sf_dir):
    """A3: routed rows per label in a fixed order."""
    return vw.value_counts(_routed(spark, sf_dir), "sentiment_label", LABEL_ORDER)


@query("selected_events")
def q_selected(spark, sf_dir):
    """Routed rows of two sectors with a non-neutral label."""
    r = vw.select_in(_routed(spark, sf_dir), {"sector": ["Alpha", "Gamma"], "sentiment_label": ["positive",
                                                                                                  "negative"]})
    return r.select("article_id", "ticker", "sector", "sentiment_label")


@query("recent_prices")
def q_recent(spark, sf_dir):
    """P10: closes within 180 days of the latest date, per series."""
    r = vw.lookback(st.sparse_prices(spark, sf_dir), "date", 180)
    return r.groupBy("name").agg(F.count(F.lit(1)).alias("n"), iso(F.min("date")).alias("first_date"))


# Stand-in event markers for the bar calendar.
EVENT_MARKERS = [("2024-01-08", "second week"), ("2024-01-15", "mid-month"), ("2024-01-29", "last week")]


@query("annotated_bars")
def q_annotated(spark, sf_dir):
    """Bars with the event marker of their day, if any."""
    ev = spark.createDataFrame(EVENT_MARKERS, "d string, marker string").select(
        F.to_date("d").alias("date"), "marker")
    b = vw.annotate(st.bars(spark, sf_dir), ev, "date")
    return rounded(b.withColumn("date", iso(F.col("date"))), {"open", "high", "low", "close"})


@query("routing_coverage")
def q_coverage_counts(spark, sf_dir):
    """Distinct tickers, sources, articles and days; first and
    last day of the routed rows."""
    r = _routed(spark, sf_dir).withColumn("day", F.to_date("published_at"))
    return r.agg(F.count_distinct("ticker").alias("n_tickers"), F.count_distinct("source").alias("n_sources"),
                 F.count_distinct("article_id").alias("n_articles"), F.count_distinct("day").alias("n_days"),
                 iso(F.min("day")).alias("first_day"), iso(F.max("day")).alias("last_day"),
                 F.count(F.lit(1)).alias("n_rows"))


@query("latest_in_flight")
def q_in_flight(spark, sf_dir):
    """P12 + P13: per entity the last probe whose next close is unknown."""
    r = asof.session_returns(st.ship_probes(spark, sf_dir), st.sparse_prices(spark, sf_dir))
    fl = vw.in_flight(r)
    return rounded(fl.groupBy("name").agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))
                   .withColumn("date", iso(F.col("date"))), {"close"})


# ---------------------------------------------------------------- streaming

from tidings.streaming import ingest as sm  # noqa: E402
from tidings.streaming.digests import DigestIndex  # noqa: E402
from tidings.streaming import resolution as rs  # noqa: E402


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Feed files arrive one topic at a time; each
    micro-batch appends articles whose whole text was never stored, after
    the label rules. Result: one row per distinct text (its SHA-256)."""
    src, sink, ckpt = _scratch(spark, "feed-src"), _scratch(spark, "feed-sink"), _scratch(spark, "feed-ckpt")
    news = _news(spark, sf_dir)
    rows = news.select("id", "topic", "headline", "source", "published_at", F.lit(None).cast("string").alias("url"),
                       F.col("sentiment_label").alias("description"))
    rows = fd.in_parts(rows, "topic", "headline").repartition("topic", "_part")
    fd.to_feed(rows).write.partitionBy("topic").json(src)  # a file or more per topic
    stream = sm.feed_stream(spark, src, max_files=1)

    def enrich(df):
        return tx.apply_label_rules(df.withColumn("sentiment_label", F.col("description")), text="headline")

    sm.append_batches(stream, sink, "headline", ["published_at", "source", "topic"], ckpt, once=True,
                      enrich=enrich).awaitTermination()
    return spark.read.parquet(sink).select(F.sha2(F.col("headline"), 256).alias("text_sha256"))


@query("stream_ingest_stats")
def q_stream_stats(spark, sf_dir):
    """A22 on the stream: counters per batch, over a sink whose index
    holds the stored articles already; equal to ingest_stats."""
    src, sink, ckpt = _scratch(spark, "stats-src"), _scratch(spark, "stats-sink"), _scratch(spark, "stats-ckpt")
    stored, batch = _stored_and_batch(spark, sf_dir)
    batch.select("id", "body").repartition(fd.part_count(batch, "body", least=2)).write.parquet(src)
    DigestIndex(spark, f"{sink}-keys").add(stored.select(F.sha2("body", 256).alias("digest")).dropna().distinct(), -1)
    stream = spark.readStream.schema(batch.select("id", "body").schema).option("maxFilesPerTrigger", 1).parquet(src)
    sm.append_batches(stream, sink, "body", ["id"], ckpt).awaitTermination()
    held = stored.agg(F.count(F.lit(1)).alias("held")).scalar()
    sums = [F.sum(c).alias(c) for c in ("fetched", "skipped", "inserted", "duplicates")]
    return sm.ingest_counters(spark, sink).agg(*sums).withColumn("total", F.col("inserted") + held)


def _news_stream(spark, sf_dir):
    """The articles as a file stream, with the digest of the text as id."""
    src = _scratch(spark, "news-src")
    news = _news(spark, sf_dir).select(F.sha2("headline", 256).alias("article_id"), "headline", "topic", "source",
                                       F.col("published_at").alias("published_ts"), "sentiment_label", "sentiment_confidence")
    news.write.parquet(src)
    return spark.readStream.schema(news.schema).parquet(src)


@query("stream_dedup_watermark")
def q_stream_dedup(spark, sf_dir):
    """One row per distinct text within the lateness bound, which here
    spans the month of the data."""
    sink, ckpt = _scratch(spark, "dedup-sink"), _scratch(spark, "dedup-ckpt")
    once = sm.dedup_within_watermark(_news_stream(spark, sf_dir), "article_id", delay="60 days")
    sm.on_each_batch(once.where(F.length("headline") > 0), lambda b, e: sm.store_batch(b, sink, e), ckpt).awaitTermination()
    return spark.read.parquet(sink).select(F.col("article_id").alias("text_sha256"))


@query("stream_routed")
def q_stream_routed(spark, sf_dir):
    """The chain of first copy, label rules and routing on the stream."""
    sink, ckpt = _scratch(spark, "routed-sink"), _scratch(spark, "routed-ckpt")
    stream = _news_stream(spark, sf_dir).where("sentiment_label IS NOT NULL").withColumn("published_at", F.col("published_ts"))
    chain = sm.enrich_chain(st.entity_dim(spark), st.topic_map(spark), st.INDEX_TICKER)
    sm.append_batches(stream, sink, "headline", ["published_at", "source", "topic", "sentiment_confidence"], ckpt,
                      enrich=chain).awaitTermination()
    return spark.read.parquet(sink).select(F.col("article_id").alias("text_sha256"), "source", "ticker", "sector", "matched_via")


@query("stream_daily_counts")
def q_stream_daily(spark, sf_dir):
    """One-day tumbling windows per topic over the article stream, update
    mode with an upsert by (window, topic)."""
    sink, ckpt = _scratch(spark, "daily-sink"), _scratch(spark, "daily-ckpt")
    agg = sm.daily_sentiment_stream(_news_stream(spark, sf_dir), "topic")
    sm.upsert_each_batch(agg, sink, ckpt).awaitTermination()
    r = sm.latest_rows(spark, sink, ["window", "topic"])
    return rounded(r.select(iso(F.col("window.start")).alias("day"), "topic", "n_headlines", "n_positive",
                            "n_negative", "n_neutral", "avg_confidence", "net_sentiment"),
                   {"avg_confidence", "net_sentiment"})


def _file_stream(spark, df, name):
    """A table as a stream of its files."""
    src = _scratch(spark, name)
    df.repartitionByRange(3, "news_date").write.parquet(src)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


@query("stream_outcomes")
def q_stream_outcomes(spark, sf_dir):
    """Predictions and returns both arrive as files, the later days'
    returns before the predictions; equal to resolved_outcomes."""
    log, actual = _index_log(spark, sf_dir)
    log, sink = written(log, "prediction-log"), _scratch(spark, "outcomes")
    rs.resolution_job(_file_stream(spark, log, "log"), _file_stream(spark, actual, "actual"), sink,
                      _scratch(spark, "outcomes-ckpt"), log.where(F.col("news_date") < F.lit("2024-01-05").cast("date")),
                      delay="60 days").awaitTermination()
    o = spark.read.parquet(sink).where("actual_direction IS NOT NULL").drop("batch")
    return rounded(o.withColumn("date", iso(F.col("date"))).withColumn("news_date", iso(F.col("news_date"))),
                   {"actual_pct_change", "error_magnitude"})


@query("stream_source_credibility")
def q_stream_sources(spark, sf_dir):
    """Running state per source over streams of outcomes and routed
    articles; equal to source_credibility."""
    sink, routed_dir = _scratch(spark, "credibility"), _scratch(spark, "routed-src")
    routed = _routed(spark, sf_dir).select("ticker", "source", "published_at")
    routed.write.parquet(routed_dir)
    rs.credibility_state_job(_file_stream(spark, _index_outcomes(spark, sf_dir), "outcomes"),
                             spark.readStream.schema(routed.schema).parquet(routed_dir), st.INDEX_TICKER, sink,
                             _scratch(spark, "credibility-ckpt"), delay="60 days").awaitTermination()
    r = sm.latest_rows(spark, sink, ["source_name", "date"])
    return rounded(r.withColumn("date", iso(F.col("date"))), {"accuracy_rate", "current_weight"})


@query("stream_retrain_check")
def q_stream_retrain(spark, sf_dir):
    """The check after the last batch; equal to retrain_trigger."""
    sink = _scratch(spark, "retrain")
    labeled = lambda: rt.labeled_news(_news(spark, sf_dir)).agg(F.count(F.lit(1)).alias("total_labeled"))
    sm.retrain_job(_file_stream(spark, _index_outcomes(spark, sf_dir), "outcomes"), labeled, LAST_RETRAIN, sink,
                   _scratch(spark, "retrain-ckpt")).awaitTermination()
    return rounded(sm.latest_batch(spark, sink), {"cumulative_weight_drift", "last_n_accuracy"})


@query("stream_signal_weights")
def q_stream_weights(spark, sf_dir):
    """The weight state machine as a stateful stream over outcome files,
    one per year, each second year before the one it follows; final states
    equal the batch fold from the stored states."""
    src, sink, ckpt = _scratch(spark, "outc-src"), _scratch(spark, "w-sink"), _scratch(spark, "w-ckpt")
    o = _signal_outcomes(spark, sf_dir)
    # the file source reads by time of writing: ranges of ``turn`` are written in ascending order
    turn = F.year("date") + F.when(F.year("date") % 2 == 0, 1).otherwise(-1)
    o.withColumn("turn", turn).repartitionByRange("turn").sortWithinPartitions("turn").write.partitionBy("turn").parquet(src)
    schema = T.StructType([*o.schema.fields, T.StructField("turn", T.IntegerType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).drop("turn")
    rs.weight_state_job(stream, SIGNAL_KEYS, sink, ckpt, _stored_weights(spark, sf_dir), delay="1100 days").awaitTermination()
    final = sm.latest_rows(spark, sink, SIGNAL_KEYS).withColumn("n_outcomes", F.col("n_outcomes").cast("int"))
    return rounded(final, {"current_weight", "pre_decay_weight", "drift"})


# ---------------------------------------------------------------- models

from tidings.operators import model as md  # noqa: E402

NO_ORACLE = {"boosted_direction_model", "feature_importance", "live_predictions", "text_classifier_cv",
             "text_scoring", "train_excluding_eval", "model_roundtrip"}


def _model_input(spark, sf_dir):
    """The feature table written to the shared checkpoint folder once:
    iterative training reads it many times, so its lineage is cut."""
    return cut_lineage(_dataset(spark, sf_dir))


def _labelled_split(spark, sf_dir):
    ds = _model_input(spark, sf_dir).where(F.col("label").isNotNull())
    return ev.time_split(ds, "date")


@query("boosted_direction_model")
def q_boosted(spark, sf_dir):
    """M8 + M13: one-vs-rest boosted trees fitted on the train part of the
    time split; predictions for the test part, none if the guard refuses (M14)."""
    p = _labelled_split(spark, sf_dir)
    train, test = p.where(F.col("part") == "train"), p.where(F.col("part") == "test")
    if ev.split_guard(p, "label").first()["ok"]:
        out = md.predict(md.train_boosted(train), test)
    else:
        out = test.limit(0).withColumn("predicted_label", F.lit(None).cast("string"))
    return out.select("ticker", iso(F.col("date")).alias("date"), "sector", "label", "predicted_label")


@query("feature_importance")
def q_importance(spark, sf_dir):
    """Importances of the boosted model fitted on all labelled rows."""
    ds = _model_input(spark, sf_dir).where(F.col("label").isNotNull())
    imp = md.feature_importance(md.train_boosted(ds))
    return spark.createDataFrame(imp, "feature string, importance double")


@query("live_predictions")
def q_live(spark, sf_dir):
    """M9 + M10 + M11 + O9: the signal-weighted model fitted on resolved
    rows scores the in-flight rows: direction, confidence and top 3 signals,
    ranked by confidence. No rows if the guard refuses (M14)."""
    ds = _model_input(spark, sf_dir)
    if ev.refusal(ds.where(F.col("label").isNotNull())):
        return spark.createDataFrame([], "ticker string, date string, predicted_label string, confidence double, top_signal string")
    m = md.train_weighted(ds.where(F.col("label").isNotNull()))
    scored = md.contributions(m, md.predict(m, ds.where(F.col("label").isNull())))
    return scored.select("ticker", iso(F.col("date")).alias("date"), "predicted_label",
                         F.round("confidence", 6).alias("confidence"),
                         F.col("top_signals")[0]["signal"].alias("top_signal")) \
        .orderBy(F.col("confidence").desc(), "ticker", "date")


def _text_labels(spark, sf_dir):
    d = st.table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = st.table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id").withColumn("label_idx", F.col("quality").cast("double"))
    w = ev.class_weights(j, "quality").select("quality", "weight")
    return j.join(F.broadcast(w), "quality")


@query("text_classifier_cv")
def q_text_cv(spark, sf_dir):
    """M2 + M3 + A25 + O11: 5-fold stratified CV of the text classifier on
    the human quality labels for a small grid of regularisation strengths;
    per config mean and population std of the fold accuracy, best config
    flagged."""
    data = cut_lineage(ev.stratified_folds(_text_labels(spark, sf_dir), "doc_id", "quality", 5, 42))
    rows = md.text_cv(data, (0.01, 0.1))
    per = spark.createDataFrame(rows, "reg double, fold int, accuracy double")
    summ = per.groupBy("reg").agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"),
                                  F.count(F.lit(1)).alias("n_folds"))
    best = summ.agg(F.max_by("reg", F.struct(F.col("mean"), -F.col("reg"))).alias("best_reg")).first()["best_reg"]
    return summ.withColumn("best", (F.col("reg") == F.lit(best)).cast("int"))


@query("text_scoring")
def q_text_scoring(spark, sf_dir):
    """M1: documents without a human label scored by the classifier fitted
    on the labelled ones; count and mean score per predicted class."""
    lab = _text_labels(spark, sf_dir)
    m = md.text_pipeline().fit(lab)
    d = st.table(spark, sf_dir, "documents").select("doc_id", "text")
    todo = d.join(lab.select("doc_id"), "doc_id", "left_anti")
    s = md.score_text(m, todo, ["low", "high"])
    return s.groupBy("predicted").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("mean_score"))


@query("train_excluding_eval")
def q_train_excluding(spark, sf_dir):
    """M4 + J17: evaluation set = a seeded 20 % hold-out of the labelled
    documents; training pool = labelled documents whose text is not in it."""
    lab = ev.holdout(_text_labels(spark, sf_dir), "doc_id", 0.2, 42)
    evl = lab.where(F.col("holdout") == 1)
    pool = lab.where(F.col("holdout") == 0).join(evl.select("text"), "text", "left_anti")
    m = md.text_pipeline().fit(pool)
    pred = m.transform(evl)
    return ev.agreement(pred.withColumn("a", F.col("label_idx").cast("int").cast("string"))
                        .withColumn("p", F.col("prediction").cast("int").cast("string")), "a", "p")


@query("model_roundtrip")
def q_roundtrip(spark, sf_dir):
    """The weighted model saved to the shared folder, loaded back and
    used to score the labelled rows."""
    ds = _model_input(spark, sf_dir).where(F.col("label").isNotNull())
    m = md.train_weighted(ds)
    path = _scratch(spark, "model")
    md.save_model(m, path, {"trained_rows": ds.count(), "features": len(md.FEATURE_COLS)})
    m2, meta = md.load_model(path), md.load_metadata(path)
    return md.predict(m2, ds).groupBy("label", "predicted_label").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("trained_rows", F.lit(int(meta["trained_rows"])).cast("long"))


@query("influential_headlines")
def q_influential(spark, sf_dir):
    """Per (entity, UTC day) the 5 strongest routed headlines."""
    r = _routed(spark, sf_dir).withColumn("date", F.to_date("published_at"))
    top = vw.influential(r, ["ticker", "date"], 5)
    return rounded(top.select("ticker", iso(F.col("date")).alias("date"), "article_id", "source",
                              "sentiment_label", "strength", "rank"), {"strength"})


@query("event_props")
def q_event_props(spark, sf_dir):
    """the JSON ``props`` of events decoded with a schema; mean and
    maximum of its ``k`` per event type."""
    e = st.table(spark, sf_dir, "events").withColumn("p", vw.json_field("props", "k int"))
    return rounded(e.groupBy("event_type").agg(F.avg("p.k").alias("mean_k"), F.max("p.k").alias("max_k"),
                                               F.count(F.lit(1)).alias("n")), {"mean_k"})


@query("text_label_validation")
def q_validation(spark, sf_dir):
    """L12 + M4: agreement of the human quality labels with the classifier
    (fitted on the pool outside a seeded 20 % evaluation set), per class."""
    lab = ev.holdout(_text_labels(spark, sf_dir), "doc_id", 0.2, 42)
    evl = lab.where(F.col("holdout") == 1)
    pool = lab.where(F.col("holdout") == 0).join(evl.select("text"), "text", "left_anti")
    pred = md.text_pipeline().fit(pool).transform(evl)
    agree, _ = vw.validate_labels(pred.withColumn("h", F.col("label_idx").cast("int").cast("string"))
                                  .withColumn("m", F.col("prediction").cast("int").cast("string")), "h", "m")
    return agree


NO_ORACLE = NO_ORACLE | {"text_label_validation"}


# ---------------------------------------------------------------- operators on their own

@query("prices_wide")
def q_prices_wide(spark, sf_dir):
    """A wide CSV of closes (a column per series), read back
    long and united with the bars."""
    path = _scratch(spark, "wide")
    wide = st.sparse_prices(spark, sf_dir).groupBy(F.col("date").alias("Date")).pivot("name").agg(F.first("close"))
    tb.write_table(wide, path, "csv")
    r = fd.union_series([fd.read_prices_wide(spark, path), st.bars(spark, sf_dir).select("name", "date", "close")])
    return rounded(r.select("name", iso(F.col("date")).alias("date"), "close"), {"close"})


@query("sector_dimension")
def q_sector_dimension(spark, sf_dir):
    """The nested dimension flattened, written as CSV, read back."""
    dim = st.nation_dim(spark, sf_dir)
    nested = dim.groupBy(F.nullif("sector", F.lit("ASIA")).alias("sector")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("ticker", "name"))).alias("m")) \
        .select(F.map_from_entries(F.array(F.struct(F.coalesce("sector", F.lit("Index")), "m"))).alias("nested"))
    path = _scratch(spark, "dimension")
    tb.write_table(vw.flatten_dim(nested, "nested"), path, "csv")
    return fd.read_sector_map(spark, path)


@query("evolved_labels")
def q_evolved(spark, sf_dir):
    """Missing columns added with their defaults, present ones kept."""
    return tb.ensure_columns(st.table(spark, sf_dir, "labels"),
                             {"toxic": ("int", 9), "reviewed": ("boolean", False), "note": ("string", None)})


@query("labeling_template")
def q_template(spark, sf_dir):
    """The columns that a labeller fills."""
    t = tb.labeling_template(_news(spark, sf_dir))
    return t.withColumn("published_at", iso(F.col("published_at")))


@query("renamed_prices")
def q_renamed(spark, sf_dir):
    """Display names by the dimension, the key where it has none."""
    b = st.bars(spark, sf_dir).select(F.when(F.col("name") == "error", "unknown").otherwise(F.col("name")).alias("name"),
                                      "date", "close")
    m = literal_table(spark, st.TICKER_SERIES[:5], "ticker string, series string")
    r = vw.rename_by_map(b, "name", m, "series", "ticker", "display")
    return rounded(r.select("name", "display", iso(F.col("date")).alias("date"), "close"), {"close"})


@query("complete_dates")
def q_complete(spark, sf_dir):
    """Closes of the days on which every series has one; a third of the
    clicks' days are taken out first."""
    b = st.bars(spark, sf_dir).where(~((F.col("name") == "click") & (F.dayofmonth("date") % 3 == 0)))
    r = ser.complete_dates(b, "name", "date", "close")
    return rounded(r.select("name", iso(F.col("date")).alias("date"), "close"), {"close"})


@query("clean_labels")
def q_clean_labels(spark, sf_dir):
    """Labels trimmed and lower-cased, blank and foreign ones
    dropped, the domain asserted."""
    raw = _news(spark, sf_dir).select("id", F.when(F.col("id") % 5 == 0, F.lit("  ")).when(F.col("id") % 7 == 0, "other")
                                      .otherwise(F.concat(F.lit(" "), F.upper("sentiment_label"), F.lit(" "))).alias("label"))
    return vw.assert_domain(vw.normalize_label(raw, "label", LABEL_ORDER), "label", LABEL_ORDER)


@query("day_fields")
def q_day_fields(spark, sf_dir):
    """Shifted day, day order, formatted day, normalised text, length."""
    o = st.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", iso(cl.shift_day(F.to_date("o_orderdate"), -3)).alias("shifted"),
                    cl.day_before("o_orderdate", F.lit("1995-06-17T10:00:00Z")).cast("int").alias("before"),
                    cl.fmt("o_orderdate", "yyyyMM").alias("month"), cl.norm_text(F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))).alias("status"),
                    cl.text_len("o_orderpriority").cast("int").alias("n"))


@query("latest_run")
def q_latest_run(spark, sf_dir):
    """The last record of a run table (the bars of one series)."""
    r = vw.latest_run(st.bars(spark, sf_dir).where(F.col("name") == INDEX_SERIES).select("date", "close", "volume"), "date")
    return rounded(r.withColumn("date", iso(F.col("date"))), {"close"})


@query("weight_snapshots")
def q_snapshots(spark, sf_dir):
    """each entity's signal weights as one map."""
    s = lr.adjust_weights(_signal_outcomes(spark, sf_dir), SIGNAL_KEYS, with_log=False, stored=_stored_weights(spark, sf_dir))
    m = lr.snapshot_map(s.withColumn("current_weight", F.round("current_weight", 6)), ["name"], "signal", "current_weight")
    return m.select("name", F.size("snapshot").alias("n_signals"), F.col("snapshot")["stock_momentum"].alias("stock_momentum"))


@query("feed_failures")
def q_feed_failures(spark, sf_dir):
    """Feed files per topic and the topics with a malformed one."""
    path = _scratch(spark, "feed-bad")
    news = _news(spark, sf_dir).select("topic", "headline", "source", "published_at", F.lit(None).cast("string").alias("url"),
                                       F.lit(None).cast("string").alias("description"))
    feed = fd.to_feed(news)
    good = feed.select("topic", F.to_json(F.struct("articles")).alias("line"))
    bad = feed.where(F.col("topic").isin("de", "fr")).select("topic", F.lit('{"articles": [').alias("line")).distinct()
    good.unionByName(bad).write.partitionBy("topic").text(path)
    return fd.topic_counts(fd.read_feed(spark, path, multi_line=False))


from tidings.functions import columns as cl  # noqa: E402
from tidings.operators import cycle as cy  # noqa: E402

NO_ORACLE = NO_ORACLE | {"retrain_cycle", "prediction_log"}


@query("retrain_cycle")
def q_retrain_cycle(spark, sf_dir):
    """Retrain on the labelled feature rows with the learned signal
    weights, history row out."""
    ds = _model_input(spark, sf_dir).where(F.col("label").isNotNull())
    weights = cy.learned_weights(lr.adjust_weights(_signal_outcomes(spark, sf_dir), SIGNAL_KEYS, with_log=False))
    _, hist = cy.retrain(spark, ds, weights, "50 new labeled headlines", "2024-02-01T00:00:00")
    return hist.select("at", "trigger", F.round("old_accuracy", 6).alias("old_accuracy"),
                       F.round("new_accuracy", 6).alias("new_accuracy"), "n_rows", "reason",
                       F.round(F.col("signal_weights")["stock_momentum"], 6).alias("stock_momentum"))


def _log_row(spark, sf_dir):
    ds = _model_input(spark, sf_dir)
    m = md.train_weighted(ds.where(F.col("label").isNotNull()))
    prices = st.entity_prices(spark, sf_dir).where(F.col("name") == st.INDEX_NAME)
    outcomes = asof.session_returns(prices.select("name", "date"), prices)
    weights = lr.adjust_weights(_index_outcomes(spark, sf_dir).withColumnRenamed("judged_signal", "signal"), ["signal"],
                                with_log=False)
    return cy.predict_and_explain(ds, m, st.INDEX_TICKER, _routed(spark, sf_dir), _news(spark, sf_dir), outcomes, weights)


@query("prediction_log")
def q_prediction_log(spark, sf_dir):
    """The explained prediction of the index entity's latest unresolved
    day, upserted into a log that holds an older version of it."""
    row = written(_log_row(spark, sf_dir), "prediction-row")
    log = cy.upsert_log(row.withColumn("prediction", F.lit("none")), row)
    return log.select("ticker", iso(F.col("news_date")).alias("news_date"), "prediction", "confidence",
                      F.to_json("top_signals").alias("top_signals"),
                      F.to_json("influential_headlines").alias("influential_headlines"),
                      F.to_json("similar_past_events").alias("similar_past_events"),
                      F.to_json("signal_weights").alias("signal_weights"))


@query("split_guard")
def q_split_guard(spark, sf_dir):
    """The guard of the time split before training."""
    return ev.split_guard(ev.time_split(_dataset(spark, sf_dir).where(F.col("label").isNotNull()), "date"), "label")
