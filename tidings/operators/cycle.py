"""Daily cycle composites: L9 (predict and explain) and L10 (retrain with
before/after accuracy and a history row), built from the operators of the
other modules."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.operators import evaluate as ev
from tidings.operators import learning as lr
from tidings.operators import model as md
from tidings.operators import similarity as sim
from tidings.operators import views as vw
from tidings.sources.tables import upsert


HISTORY_SCHEMA = ("at string, trigger string, old_accuracy double, new_accuracy double, n_rows long, reason string, "
                  "signal_weights map<string,double>")


def learned_weights(state: DataFrame) -> dict[str, float]:
    """Per signal the mean of its keys' current weights, 1.0 where no outcome
    was judged: a row per configured signal."""
    seen = {r["signal"]: r["w"] for r in state.groupBy("signal").agg(F.avg("current_weight").alias("w")).collect()}
    return {s: float(seen.get(s, lr.DEFAULT_WEIGHT)) for s in lr.SIGNAL_FEATURES}


def retrain(spark: SparkSession, labelled: DataFrame, weights: dict[str, float], trigger: str, at: str,
            old_weights: dict[str, float] | None = None, min_rows: int = ev.MIN_ROWS) -> tuple[PipelineModel | None, DataFrame]:
    """Fit the model with the learned signal weights on all labelled
    rows. Accuracy before and after: models with the weights that were in
    force (``old_weights``, default 1.0) and with the new ones, both fitted on
    the time split's train part, on its test part. A guard that fails (M14)
    gives no model and a history row with the reason."""
    parts = ev.time_split(labelled, "date")
    guard = ev.split_guard(parts, "label", min_rows).first()
    if not guard["ok"]:
        return None, spark.createDataFrame([(at, trigger, None, None, guard["rows"], guard["reason"], weights)], HISTORY_SCHEMA)
    train, test = parts.where(F.col("part") == "train"), parts.where(F.col("part") == "test")

    def accuracy(w: dict[str, float]) -> float:
        m = md.train_weighted(train, w)
        return float(md.predict(m, test).agg(F.avg((F.col("predicted_label") == F.col("label")).cast("int"))).first()[0])

    hist = [(at, trigger, accuracy(old_weights or {}), accuracy(weights), guard["rows"], None, weights)]
    return md.train_weighted(labelled, weights), spark.createDataFrame(hist, HISTORY_SCHEMA)


def predict_and_explain(features: DataFrame, model: PipelineModel, entity: str, routed: DataFrame, news: DataFrame,
                        outcomes: DataFrame, weights: DataFrame, k_headlines: int = 5, k_similar: int = 3) -> DataFrame:
    """One prediction-log row for the entity's latest unresolved day:
    direction and confidence, top 3 signals by contribution, the strongest
    headlines of that day, the most similar texts of all earlier news
    (TF-IDF fitted on them) with what followed them, and a snapshot of the
    signal weights.

    ``news``: (id, headline, published_at); ``outcomes``: (date,
    next_session_return, label) of the entity; ``weights``: (signal,
    current_weight). ``upsert_log`` stores the row.
    """
    row = vw.latest_in_flight(features, "ticker", entity)
    scored = md.contributions(model, md.predict(model, row))
    today = routed.where(F.col("ticker") == entity).withColumn("date", F.to_date("published_at")) \
        .join(row.select("date"), "date", "left_semi")
    dated = news.select("id", "headline", F.to_date("published_at").alias("date"))
    past = dated.join(row.select(F.col("date").alias("_d")), F.col("date") < F.col("_d"), "left_semi")
    heads = vw.influential(today, ["ticker"], k_headlines).groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct("rank", "headline", "source", "sentiment_label"))).alias("_h"))
    sims = sim.similar_docs(today.select(F.col("article_id").alias("_qid"), "headline"), past.select("id", "headline"),
                            "_qid", "headline", "id", "headline", k=k_similar)
    events = sims.join(past, "id").join(outcomes.select("date", "next_session_return", "label"), "date", "left")
    similar = events.agg(F.sort_array(F.collect_list(F.struct(
        "rank", "headline", F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("similarity", 3).alias("similarity"),
        F.round("next_session_return", 2).alias("next_session_return"),
        F.coalesce("label", F.lit("unresolved")).alias("outcome")))).alias("similar")).withColumn("ticker", F.lit(entity))
    snapshot = lr.snapshot_map(weights.withColumn("ticker", F.lit(entity)), ["ticker"], "signal", "current_weight")
    out = scored.select("ticker", F.col("date").alias("news_date"), F.col("predicted_label").alias("prediction"),
                        F.round("confidence", 4).alias("confidence"), "top_signals")
    return (out.join(heads, "ticker", "left").join(similar, "ticker", "left").join(snapshot, "ticker", "left")
            .select("ticker", "news_date", "prediction", "confidence", "top_signals",
                    F.transform("_h", lambda h: h.dropFields("rank")).alias("influential_headlines"),
                    F.transform("similar", lambda s: s.dropFields("rank")).alias("similar_past_events"),
                    F.col("snapshot").alias("signal_weights")))


def upsert_log(stored: DataFrame, row: DataFrame) -> DataFrame:
    """S10 on the prediction log: one row per (ticker, news_date), the newest."""
    return upsert(stored.withColumn("_version", F.lit(0)), row.withColumn("_version", F.lit(1)), ["ticker", "news_date"],
                  "_version").drop("_version")
