"""Learning loop: outcome resolution (L5), signal-weight state machine (L6),
source credibility (L7, W9, W10), retrain trigger (L4, W12), forward
signals (L8, J21), streaks (W11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.columns import clamp, label_from_return
from tidings.sources.tables import upsert

# Fixed values of the learning rules.
MIN_WEIGHT, MAX_WEIGHT, DEFAULT_WEIGHT = 0.2, 2.0, 1.0
DECAY_STREAK, RESTORE_STREAK = 3, 2
ADJUSTMENT_EVERY, ADJUSTMENT_STEP = 5, 0.10
DECAY_FACTOR = 0.5
PRECEDENT_MIN = 0.15
SOURCE_MIN_SEEN, SOURCE_LOW, SOURCE_HIGH = 20, 0.40, 0.65
SOURCE_LOW_WEIGHT, SOURCE_HIGH_WEIGHT = 0.3, 1.5
RETRAIN_NEW_ROWS, RETRAIN_DRIFT, RETRAIN_LAST_N, RETRAIN_MIN_ACC = 50, 0.20, 10, 0.38

# Signal -> feature columns it covers ("sector" is not a
# weight-adjustable signal).
SIGNAL_FEATURES = {
    "sentiment": ["net_sentiment", "pct_positive", "pct_negative", "pct_neutral", "avg_confidence"],
    "headline_volume": ["n_headlines"],
    "stock_momentum": ["prior_1d_return", "prior_3d_return"],
    "market_sentiment": ["market_net_sentiment"],
    "nifty_momentum": ["nifty_market_prior_1d_return"],
    "sp500": ["sp500_prior_1d_return"],
    "crude_oil": ["crude_oil_prior_1d_return"],
    "usdinr": ["usdinr_prior_1d_return"],
    "india_vix": ["india_vix_prior_1d_return"],
    "day_of_week": ["day_of_week"],
}

SIGNAL_ITEM = T.StructType([T.StructField("signal", T.StringType()), T.StructField("contribution", T.DoubleType())])
SIMILAR_ITEM = T.StructType([T.StructField("headline", T.StringType()), T.StructField("date", T.StringType()),
                             T.StructField("similarity", T.DoubleType()),
                             T.StructField("next_session_return", T.DoubleType()),
                             T.StructField("outcome", T.StringType())])


# ---------------------------------------------------------------- L5

def resolve_outcomes(log: DataFrame, resolved: DataFrame, actual_returns: DataFrame,
                     flat: float = 0.3) -> DataFrame:
    """Outcomes for predictions not resolved yet.

    ``log``: (date, prediction, top_signals ARRAY<STRUCT<signal,
    contribution>>, similar ARRAY<STRUCT<..., similarity, ...>>, news_date);
    ``resolved``: existing outcomes (date, ...); ``actual_returns``:
    (news_date, actual_pct_change). Rows whose return is not known yet are
    left out (retried next run).
    """
    todo = log.join(resolved.select("date"), "date", "left_anti").where(F.col("news_date").isNotNull())
    r = todo.join(actual_returns.select("news_date", "actual_pct_change"), "news_date", "inner") \
        .where(F.col("actual_pct_change").isNotNull())
    return r.select(*outcome_columns(flat))


def outcome_columns(flat: float = 0.3) -> list[Column]:
    """The columns of an outcome, from a logged prediction beside its
    ``actual_pct_change`` (all NULL but the prediction where that is NULL)."""
    actual = F.when(F.col("actual_pct_change").isNotNull(), label_from_return(F.col("actual_pct_change"), flat))
    correct = (actual == F.col("prediction")).cast("int")
    similar = F.coalesce(F.col("similar"), F.array().cast(T.ArrayType(SIMILAR_ITEM)))
    max_sim = F.array_max(F.transform(similar, lambda e: F.coalesce(e["similarity"], F.lit(0.0))))
    no_precedent = (F.size(similar) == 0) | (max_sim < PRECEDENT_MIN)
    first = F.element_at(F.col("top_signals"), 1)["signal"]
    main = (F.when(correct.isNull() | (correct == 1), F.lit(None).cast("string"))
            .when(no_precedent, F.lit("no_precedent")).otherwise(first))
    return [F.col("date"), F.col("prediction").alias("predicted"), actual.alias("actual_direction"),
            F.col("actual_pct_change"), correct.alias("correct"),
            F.when(correct == 1, F.lit(0.0)).otherwise(F.abs("actual_pct_change")).alias("error_magnitude"),
            main.alias("main_error_signal"), F.when(correct.isNotNull(), first).alias("judged_signal"), F.col("news_date")]


# ---------------------------------------------------------------- L6

_LOG_ITEM = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("reason", T.StringType()),
    T.StructField("weight_before", T.DoubleType()), T.StructField("weight_after", T.DoubleType()),
    T.StructField("decay_triggered", T.IntegerType()), T.StructField("kind", T.StringType()),
])
_STATE = T.StructType([
    T.StructField("w", T.DoubleType()), T.StructField("cw", T.IntegerType()), T.StructField("cc", T.IntegerType()),
    T.StructField("wa", T.IntegerType()), T.StructField("ca", T.IntegerType()),
    T.StructField("pd", T.DoubleType()), T.StructField("drift", T.DoubleType()),
    T.StructField("log", T.ArrayType(_LOG_ITEM)),
])


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a lambda of one Column)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _entry(date, reason, before, after, decay, kind) -> Column:
    return F.struct(date.cast("date").alias("date"), F.lit(reason).alias("reason"),
                    before.cast("double").alias("weight_before"), after.cast("double").alias("weight_after"),
                    F.lit(decay).cast("int").alias("decay_triggered"), F.lit(kind).alias("kind"))


def _step(s: Column, x: Column, with_log: bool = True) -> Column:
    """One outcome applied to the state.
    Without ``with_log`` the change log stays empty (cheaper state)."""
    ok = x["correct"] == 1
    lo, hi = MIN_WEIGHT, MAX_WEIGHT

    def logged(log, entry):
        return F.array_append(log, entry) if with_log else log

    def tallies(s):
        return F.struct(
            s["w"].alias("w"),
            F.when(ok, 0).otherwise(s["cw"] + 1).alias("cw"),
            F.when(ok, s["cc"] + 1).otherwise(0).alias("cc"),
            F.when(ok, s["wa"]).otherwise(s["wa"] + 1).alias("wa"),
            F.when(ok, s["ca"] + 1).otherwise(s["ca"]).alias("ca"),
            s["pd"].alias("pd"), s["drift"].alias("drift"), s["log"].alias("log")).cast(_STATE)

    def decay_or_restore(s):
        decay = (s["cw"] >= DECAY_STREAK) & s["pd"].isNull()
        restore = (s["cc"] >= RESTORE_STREAK) & s["pd"].isNotNull()
        w_dec = clamp(s["w"] * DECAY_FACTOR, lo, hi)
        w_res = clamp(s["pd"], lo, hi)
        after_decay = F.struct(
            w_dec.alias("w"), F.lit(0).alias("cw"), s["cc"].alias("cc"), s["wa"].alias("wa"), s["ca"].alias("ca"),
            s["w"].alias("pd"), (s["drift"] + F.abs(w_dec - s["w"])).alias("drift"),
            logged(s["log"], _entry(x["date"], f"{DECAY_STREAK} consecutive wrong predictions",
                                    s["w"], w_dec, 1, "decay")).alias("log")).cast(_STATE)
        after_restore = F.struct(
            w_res.alias("w"), s["cw"].alias("cw"), F.lit(0).alias("cc"), s["wa"].alias("wa"), s["ca"].alias("ca"),
            F.lit(None).cast("double").alias("pd"), (s["drift"] + F.abs(w_res - s["w"])).alias("drift"),
            logged(s["log"], _entry(x["date"], f"restored after {RESTORE_STREAK} consecutive correct",
                                    s["w"], w_res, 0, "restore")).alias("log")).cast(_STATE)
        return F.when(decay, after_decay).when(restore, after_restore).otherwise(s)

    def periodic(s):
        down = s["wa"] >= ADJUSTMENT_EVERY
        up = s["ca"] >= ADJUSTMENT_EVERY
        w_dn = clamp(s["w"] * (1 - ADJUSTMENT_STEP), lo, hi)
        w_up = clamp(s["w"] * (1 + ADJUSTMENT_STEP), lo, hi)
        after_dn = F.struct(
            w_dn.alias("w"), s["cw"].alias("cw"), s["cc"].alias("cc"), F.lit(0).alias("wa"), s["ca"].alias("ca"),
            s["pd"].alias("pd"), (s["drift"] + F.abs(w_dn - s["w"])).alias("drift"),
            logged(s["log"], _entry(x["date"], f"{ADJUSTMENT_EVERY} wrong attributions reached",
                                    s["w"], w_dn, 0, "down")).alias("log")).cast(_STATE)
        after_up = F.struct(
            w_up.alias("w"), s["cw"].alias("cw"), s["cc"].alias("cc"), s["wa"].alias("wa"), F.lit(0).alias("ca"),
            s["pd"].alias("pd"), (s["drift"] + F.abs(w_up - s["w"])).alias("drift"),
            logged(s["log"], _entry(x["date"], f"{ADJUSTMENT_EVERY} correct attributions reached",
                                    s["w"], w_up, 0, "up")).alias("log")).cast(_STATE)
        return F.when(down, after_dn).when(up, after_up).otherwise(s)

    return _let(_let(tallies(s), decay_or_restore), periodic)


STORED_STATE = {"current_weight": "w", "consecutive_wrong": "cw", "consecutive_correct": "cc",
                "wrong_since_adjustment": "wa", "correct_since_adjustment": "ca", "pre_decay_weight": "pd"}


def adjust_weights(outcomes: DataFrame, keys: list[str], date_col: str = "date", correct_col: str = "correct",
                   with_log: bool = True, stored: DataFrame | None = None, signal_col: str = "signal",
                   signals=tuple(SIGNAL_FEATURES)) -> DataFrame:
    """Run the weight state machine over each key's outcomes in date
    order. A key starts from its row of ``stored`` (the keys and the columns
    of STORED_STATE), else from weight 1.0 with zero counters; stored keys
    without an outcome come back unchanged. Outcomes
    whose ``signal_col`` is NULL or not one of ``signals`` are skipped.

    Returns one row per key with the final state (weight, counters,
    pre-decay weight, drift of this run) and ``log``, the list of weight
    changes.

    The fold is one JVM expression (``aggregate`` over the key's outcomes
    sorted by date, then outcome, so it is deterministic). Outcomes are
    keyed by date (one prediction per day and key), so a group is bounded by
    the calendar, not by the data volume. No judged row is dropped.
    """
    o = outcomes.where(F.col(signal_col).isin(list(signals))) \
        .select(*keys, F.col(date_col).cast("date").alias("_d"), F.col(correct_col).cast("int").alias("_c")) \
        .where(F.col("_c").isNotNull())
    hist = o.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_d").alias("date"),
                                                                     F.col("_c").alias("correct")))).alias("_h"))
    first = {"w": F.lit(DEFAULT_WEIGHT), "cw": F.lit(0), "cc": F.lit(0), "wa": F.lit(0), "ca": F.lit(0),
             "pd": F.lit(None).cast("double")}
    if stored is not None:
        s = stored.select(*keys, *[F.col(c).alias(f"_s_{f}") for c, f in STORED_STATE.items()])
        hist = hist.join(s, keys, "full").withColumn("_h", F.coalesce("_h", F.array().cast(
            "array<struct<date:date,correct:int>>")))
        first = {f: F.coalesce(F.col(f"_s_{f}"), v) for f, v in first.items()}
    init = F.struct(*[v.alias(f) for f, v in first.items()], F.lit(0.0).alias("drift"),
                    F.array().cast(T.ArrayType(_LOG_ITEM)).alias("log")).cast(_STATE)
    final = hist.select(*keys, F.aggregate("_h", init, lambda s, x: _step(s, x, with_log)).alias("_s"),
                        F.size("_h").alias("n_outcomes"))
    return final.select(*keys, F.col("_s.w").alias("current_weight"), F.col("_s.cw").alias("consecutive_wrong"),
                        F.col("_s.cc").alias("consecutive_correct"), F.col("_s.wa").alias("wrong_since_adjustment"),
                        F.col("_s.ca").alias("correct_since_adjustment"), F.col("_s.pd").alias("pre_decay_weight"),
                        F.col("_s.drift").alias("drift"), "n_outcomes", F.col("_s.log").alias("log"))


def drift_since(state: DataFrame, keys: list[str], last_retrain) -> DataFrame:
    """One row with the sum of absolute weight changes after the last
    retrain (a date; None counts all of them)."""
    rows = weight_changes(state, keys)
    if last_retrain is not None:
        rows = rows.where(F.col("date") > F.lit(last_retrain).cast("date"))
    return rows.agg(F.coalesce(F.sum(F.abs(F.col("weight_after") - F.col("weight_before"))), F.lit(0.0))
                    .alias("cumulative_weight_drift"))


def weight_changes(state: DataFrame, keys: list[str], decay_restore_only: bool = False) -> DataFrame:
    """Change log of ``adjust_weights`` as rows (prediction_errors rows when
    ``decay_restore_only``)."""
    rows = state.select(*keys, F.inline("log"))
    if decay_restore_only:
        rows = rows.where(F.col("kind").isin("decay", "restore"))
    return rows


# ---------------------------------------------------------------- W11

def streaks(df: DataFrame, keys: list[str], date_col: str, flag: str) -> DataFrame:
    """Length of the current run of equal ``flag`` values up to each
    row (gaps and islands: difference of two row numbers). Per key one row
    per date, so a key's window is bounded by the calendar."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    w2 = Window.partitionBy(*keys, flag).orderBy(date_col)
    g = df.withColumn("_island", F.row_number().over(w) - F.row_number().over(w2))
    return g.withColumn("streak", F.row_number().over(Window.partitionBy(*keys, flag, "_island").orderBy(date_col))) \
        .drop("_island")


# ---------------------------------------------------------------- L7, W9, W10

def source_credibility(outcomes: DataFrame, routed: DataFrame, index_ticker: str,
                       ts: str = "published_at") -> DataFrame:
    """Every source with a headline routed to ``index_ticker`` on an
    outcome's news day shares that outcome. Per source, in date order:
    running totals (W9) and a sticky weight (W10): after at least 20
    outcomes, accuracy < 0.40 sets 0.3 and > 0.65 sets 1.5; otherwise the
    last set weight (default 1.0) stays. One row per (source, date).
    """
    srcs = (routed.where((F.col("ticker") == index_ticker) & F.col("source").isNotNull())
            .select("source", F.to_date(F.col(ts)).alias("news_date")).distinct())
    o = outcomes.select("news_date", "date", "correct")
    ev = srcs.join(o, "news_date")
    w = Window.partitionBy("source").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    ev = ev.withColumn("total_predictions", F.count(F.lit(1)).over(w)) \
        .withColumn("correct_predictions", F.sum("correct").over(w)) \
        .withColumn("accuracy_rate", F.col("correct_predictions") / F.col("total_predictions"))
    trig = (F.when((F.col("total_predictions") >= SOURCE_MIN_SEEN) & (F.col("accuracy_rate") < SOURCE_LOW),
                   F.lit(SOURCE_LOW_WEIGHT))
            .when((F.col("total_predictions") >= SOURCE_MIN_SEEN) & (F.col("accuracy_rate") > SOURCE_HIGH),
                  F.lit(SOURCE_HIGH_WEIGHT)))
    ev = ev.withColumn("_t", trig).withColumn(
        "current_weight", F.coalesce(F.last("_t", ignorenulls=True).over(w), F.lit(DEFAULT_WEIGHT))).drop("_t")
    return ev.select(F.col("source").alias("source_name"), "date", "total_predictions", "correct_predictions",
                     "accuracy_rate", "current_weight")


def latest_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """S10 helper: the last row per key (``max_by`` over a struct, a
    map-side combinable aggregate)."""
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r")).select(*keys, "_r.*")


# ---------------------------------------------------------------- L4, W12

def last_n_accuracy(outcomes: DataFrame, n: int = RETRAIN_LAST_N, date_col: str = "date") -> DataFrame:
    """Accuracy over the ``n`` most recent outcomes and their count."""
    last = outcomes.orderBy(F.col(date_col).desc()).limit(n)
    return last.agg(F.avg("correct").alias("last_n_accuracy"), F.count(F.lit(1)).alias("last_n"))


def retrain_trigger(state: DataFrame, labeled_count: DataFrame, recent: DataFrame) -> DataFrame:
    """L4: one row (should_retrain, reason) from three scalars: new labelled
    rows since the last training, cumulative weight drift, and accuracy of
    the last 10 outcomes. All inputs are one-row frames."""
    one = state.select("last_retrain_headline_count", "cumulative_weight_drift", F.lit(1).alias("_k")) \
        .join(labeled_count.select("total_labeled", F.lit(1).alias("_k")), "_k") \
        .join(recent.select("last_n_accuracy", "last_n", F.lit(1).alias("_k")), "_k")
    new_rows = F.col("total_labeled") - F.col("last_retrain_headline_count")
    reason = (F.when(new_rows >= RETRAIN_NEW_ROWS,
                     F.concat(new_rows.cast("string"), F.lit(" new labeled headlines since last training")))
              .when(F.col("cumulative_weight_drift") > RETRAIN_DRIFT,
                    F.concat(F.lit("cumulative signal weight drift "),
                             F.format_number(F.col("cumulative_weight_drift"), 2), F.lit(f" > {RETRAIN_DRIFT:.2f}")))
              .when((F.col("last_n") >= RETRAIN_LAST_N) & (F.col("last_n_accuracy") < RETRAIN_MIN_ACC),
                    F.concat(F.lit(f"accuracy over last {RETRAIN_LAST_N} predictions ("),
                             F.round(F.col("last_n_accuracy") * 100, 0).cast("int").cast("string"),
                             F.lit(f"%) below {int(RETRAIN_MIN_ACC * 100)}%"))))
    return one.select(reason.isNotNull().cast("int").alias("should_retrain"), reason.alias("reason"),
                      new_rows.alias("new_rows"), "cumulative_weight_drift", "last_n_accuracy", "last_n")


# ---------------------------------------------------------------- L8, J21

FORWARD_RULE_SCHEMA = ("signal_type string, series string, op string, threshold double, sectors array<string>, "
                       "divisor double")


def forward_signals(changes: DataFrame, rules: DataFrame, dim: DataFrame, topic_rows: DataFrame | None = None,
                    topic_sector: str | None = None, topic_signal: str = "rbi_news",
                    topic_confidence: float = 0.6, date=None) -> DataFrame:
    """Fired rules -> one row per member of each target sector (J21); a
    sector without members yields one row with a NULL stock. ``date`` (a
    column or value, the day that the signals are for) becomes a column, the
    first part of the key of ``upsert_signals``.

    ``changes``: (series, change_pct) latest change per series (W6);
    ``rules``: FORWARD_RULE_SCHEMA rows, op in ('>', '<', 'abs>'),
    confidence = min(|change| / divisor, 1); ``topic_rows``: headlines of the
    watched topic on the last price date (headline column), which fire
    ``topic_signal`` for the members of ``topic_sector`` with the first
    headline.
    """
    r = rules.join(changes, "series")
    fired = r.where(F.when(F.col("op") == ">", F.col("change_pct") > F.col("threshold"))
                    .when(F.col("op") == "<", F.col("change_pct") < F.col("threshold"))
                    .otherwise(F.abs(F.col("change_pct")) > F.col("threshold")))
    fired = fired.select("signal_type", F.explode("sectors").alias("sector"),
                         F.least(F.abs(F.col("change_pct")) / F.col("divisor"), F.lit(1.0)).alias("confidence"),
                         F.lit(None).cast("string").alias("source_headline"),
                         F.format_string("%s moved %+.2f%%", F.col("series"), F.col("change_pct")).alias("reasoning"))
    if topic_rows is not None and topic_sector is not None:
        first = topic_rows.agg(F.min_by("headline", F.struct(*[c for c in topic_rows.columns])).alias("h"),
                               F.count(F.lit(1)).alias("n"))
        t = first.where(F.col("n") > 0).select(
            F.lit(topic_signal).alias("signal_type"), F.lit(topic_sector).alias("sector"),
            F.lit(topic_confidence).alias("confidence"), F.col("h").alias("source_headline"),
            F.lit("topic news on the last price date").alias("reasoning"))
        fired = fired.unionByName(t)
    members = dim.select("sector", F.col("ticker").alias("stock"))
    return fired.join(members, "sector", "left").select(
        F.lit(date).cast("date").alias("date"), "sector", "stock", "signal_type", "reasoning", "source_headline", "confidence")


SIGNAL_KEY = ["date", "sector", "stock", "signal_type"]


def upsert_signals(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The watch list with ``new`` rows replacing those of the same date,
    sector, stock (NULL included) and signal type."""
    return upsert(stored.withColumn("_version", F.lit(0)), new.withColumn("_version", F.lit(1)), SIGNAL_KEY, "_version") \
        .drop("_version")


def snapshot_map(df: DataFrame, keys: list[str], k: str, v: str) -> DataFrame:
    """per key a MAP<k, v> snapshot (e.g. the signal weights of a day).
    The map holds one entry per configured signal or source, so the
    collected group is bounded by that configuration."""
    return df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(k), F.col(v)))).alias("snapshot"))
