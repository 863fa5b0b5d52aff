"""Structured Streaming jobs.

Feeds are polled hourly over an overlapping window and a headline is kept
only once. A file stream reads feed folders; each micro-batch is
de-duplicated against everything already stored (exact "ever seen", by
anti-join against the digests of stored keys) and, for a bounded-state
alternative, ``dropDuplicatesWithinWatermark`` keeps only keys of the last
``delay``.
Per-row enrichment (rules, routing) runs inside ``foreachBatch`` where
batch operators (windows, joins) are available.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidings.functions.columns import sentiment_sign
from tidings.operators.learning import adjust_weights, drift_since, last_n_accuracy, resolve_outcomes, retrain_trigger
from tidings.operators.routing import labeled_news, route
from tidings.operators.text import apply_label_rules
from tidings.sources.feeds import FEED_SCHEMA, flatten_articles
from tidings.sources.tables import first_by_key
from tidings.streaming.digests import DigestIndex, append_unseen

LATENESS = "2 days"


def feed_stream(spark: SparkSession, src: str, multi_line: bool = False, max_files: int | None = None) -> DataFrame:
    """Articles of the feed files arriving under ``src`` (folders
    ``topic=<name>/``), flattened, with a parsed ``published_ts``."""
    schema = T.StructType(FEED_SCHEMA.fields + [T.StructField("topic", T.StringType())])
    r = spark.readStream.schema(schema).option("multiLine", multi_line) \
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    flat = flatten_articles(r.json(src))
    return flat.withColumn("published_ts", F.try_to_timestamp(F.col("published_at")))


def dedup_within_watermark(stream: DataFrame, key: str = "headline", ts: str = "published_ts",
                           delay: str = LATENESS) -> DataFrame:
    """R2/R3 (bounded state): drop repeats of a key seen within ``delay``."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def trigger_kwargs(once: bool, every: str = "1 hour") -> dict:
    """Drain what is there and stop (``availableNow``), or run on a
    processing-time schedule."""
    return {"availableNow": True} if once else {"processingTime": every}


def _batch_folder(path: str, epoch: int) -> str:
    return f"{path}/batch={epoch}"


def start_folder(spark: SparkSession, path: str, schema) -> None:
    """An empty Parquet folder, so that the first batch reads it like any
    other and every read error is a real one."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(_batch_folder(path, -1))


def stored_batches(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """The rows that the batches before ``before`` have stored under ``path``
    (all batches without it), with their ``batch``. A batch that is run again
    does not see itself, and overwrites its own folder: nothing is lost or
    repeated when a job fails between its writes."""
    fields = T.StructType(list(schema.fields) + [T.StructField("batch", T.LongType())])
    rows = spark.read.schema(fields).parquet(path)
    return rows if before is None else rows.where(F.col("batch") < before)


def store_batch(df: DataFrame, path: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(_batch_folder(path, epoch))


def append_batches(stream: DataFrame, sink: str, key: str, order: list[str], checkpoint: str,
                   once: bool = True, enrich: Callable[[DataFrame], DataFrame] | None = None,
                   every: str = "1 hour") -> StreamingQuery:
    """R2 (exact) + R5: each micro-batch keeps the first row per key
    (``order``) whose key was never stored, optionally enriches it (score,
    rules, routing) and appends it. ``sink`` is a Parquet folder with one
    sub-folder per batch; the SHA-256 of every stored key is kept beside it in
    a ``DigestIndex``, so a batch reads the digest files that may hold one of
    its keys, not the stored texts. The checkpoint makes a restarted job resume
    after the last committed batch.

    A22: rows fetched, skipped (empty key) and inserted are counted per batch
    and stored beside it (``ingest_counters``). They are plain aggregates: an
    observed metric is lost when adaptive execution drops its branch, as it does
    for a batch or an index without rows."""
    spark = stream.sparkSession
    index = DigestIndex(spark, f"{sink}-keys")

    def write(batch: DataFrame, epoch: int) -> None:
        empty = F.col(key).isNull() | (F.length(F.col(key)) == 0)
        fetched, skipped = batch.agg(F.count(F.lit(1)), F.count_if(empty)).first()
        new = append_unseen(index, batch, key, epoch, lambda d: first_by_key(d, ["digest"], order)).persist()
        rows = new.select(*batch.columns)
        store_batch(rows if enrich is None else enrich(rows), sink, epoch)
        index.add(new, epoch)
        counts = [(fetched, skipped, new.count())]
        store_batch(spark.createDataFrame(counts, "fetched long, skipped long, inserted long").coalesce(1),
                    f"{sink}-counters", epoch)
        new.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, every)).start())


def ingest_counters(spark: SparkSession, sink: str) -> DataFrame:
    """Per batch of ``append_batches`` the rows fetched, skipped, inserted
    and duplicate; no article is read."""
    return spark.read.parquet(f"{sink}-counters").withColumn(
        "duplicates", F.col("fetched") - F.col("skipped") - F.col("inserted"))


def enrich_chain(dim: DataFrame, topic_map: DataFrame, index_ticker: str, text: str = "headline",
                 score: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Score, correct by the label rules, route. ``score`` adds
    sentiment_label and sentiment_confidence (rows that have them need none);
    rows without a label are not routed."""
    def run(rows: DataFrame) -> DataFrame:
        labelled = apply_label_rules(rows if score is None else score(rows), text=text)
        return route(labeled_news(labelled), dim, topic_map, index_ticker, "article_id", text)
    return run


def daily_sentiment_stream(stream: DataFrame, key: str = "ticker", ts: str = "published_ts",
                           delay: str = LATENESS) -> DataFrame:
    """Tumbling one-day windows per key with a lateness bound: counts,
    label counts, mean confidence and mean signed confidence."""
    w = stream.withWatermark(ts, delay).withColumn("_w", sentiment_sign(F.col("sentiment_label")) *
                                                   F.col("sentiment_confidence"))
    return w.groupBy(F.window(ts, "1 day").alias("window"), key).agg(
        F.count(F.lit(1)).alias("n_headlines"),
        F.count_if(F.col("sentiment_label") == "positive").alias("n_positive"),
        F.count_if(F.col("sentiment_label") == "negative").alias("n_negative"),
        F.count_if(F.col("sentiment_label") == "neutral").alias("n_neutral"),
        F.avg("sentiment_confidence").alias("avg_confidence"), F.avg("_w").alias("net_sentiment"))


def upsert_each_batch(stream: DataFrame, sink: str, checkpoint: str, once: bool = True,
                      every: str = "1 hour") -> StreamingQuery:
    """Store what a micro-batch has changed (update mode, so the watermark
    can drop finished windows from the state); ``latest_rows`` reads the last
    version of each key."""
    return (stream.writeStream.outputMode("update").foreachBatch(lambda b, e: store_batch(b, sink, e))
            .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(once, every)).start())


def latest_rows(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """The last stored version of each key."""
    rows = spark.read.parquet(sink)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def _now(table):
    """A table, or what a reader gives at this moment."""
    return table() if callable(table) else table


def resolve_job(returns: DataFrame, log: DataFrame | Callable[[], DataFrame], sink: str, checkpoint: str, resolved: DataFrame | None = None,
                once: bool = True, every: str = "1 day") -> StreamingQuery:
    """Whenever actual returns (news_date, actual_pct_change) arrive,
    resolve the logged predictions that have no outcome yet, neither in
    ``resolved`` nor in an earlier batch, and append their outcomes. ``log`` is
    a table or a reader that each batch calls. ``resolution.resolution_job``
    takes the log as a stream of its own."""
    spark, first = returns.sparkSession, _now(log)
    schema = resolve_outcomes(first, first.select("date").limit(0), first.select(
        "news_date", F.lit(0.0).alias("actual_pct_change"))).schema
    start_folder(spark, sink, schema)

    def write(batch: DataFrame, epoch: int) -> None:
        known = stored_batches(spark, sink, schema, epoch).select("date")
        if resolved is not None:
            known = known.unionByName(resolved.select("date"))
        store_batch(resolve_outcomes(_now(log), known, batch), sink, epoch)

    return (returns.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, every)).start())


def history_job(outcomes: DataFrame, compute: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                once: bool = True, every: str = "1 day") -> StreamingQuery:
    """Store each micro-batch of outcomes and recompute a table from all
    outcomes so far; ``latest_batch`` reads the newest table. Outcomes are
    one a day, so the history is bounded by the calendar."""
    spark, schema, history = outcomes.sparkSession, outcomes.schema, f"{sink}-history"
    start_folder(spark, history, schema)

    def write(batch: DataFrame, epoch: int) -> None:
        store_batch(batch, history, epoch)
        store_batch(compute(stored_batches(spark, history, schema, epoch + 1).drop("batch")), sink, epoch)

    return (outcomes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, every)).start())


def latest_batch(spark: SparkSession, sink: str) -> DataFrame:
    rows = spark.read.parquet(sink)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def retrain_job(outcomes: DataFrame, labeled_count: DataFrame | Callable[[], DataFrame], last_retrain, sink: str, checkpoint: str,
                last_count: int = 0, **options) -> StreamingQuery:
    """The retrain check after each batch of outcomes; ``labeled_count`` is
    a table or a reader that each batch calls."""
    def check(o: DataFrame) -> DataFrame:
        state = adjust_weights(o.withColumnRenamed("judged_signal", "signal"), ["signal"])
        drift = drift_since(state, ["signal"], last_retrain) \
            .withColumn("last_retrain_headline_count", F.lit(last_count).cast("long"))
        return retrain_trigger(drift, _now(labeled_count), last_n_accuracy(o))
    return history_job(outcomes, check, sink, checkpoint, **options)


def on_each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True,
                  every: str = "1 hour", mode: str = "append") -> StreamingQuery:
    """Run a batch function on every micro-batch."""
    return (stream.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, every)).start())
