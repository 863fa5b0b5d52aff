"""The learning loop on streams whose rows come in any order.

Predictions and closes are both streams: an outer join in event time holds a
row of either side until its partner arrives or the lateness bound has passed,
so a prediction may be logged after the job has started and a return may come
before its prediction.

Weights and credibility are folds in date order over one key's outcomes. A key
keeps the folded state (a value), the outcomes of days that may still change (a
map from day to counts) and a timer per day. When the watermark passes a day,
its timer folds the day into the state and frees it; until then each batch
emits the fold of the waiting days on top of the state, without storing it. A
batch reads its own rows and the states of the keys in it, never the history.

Rows later than the bound are dropped by Spark: choose ``delay`` from the
sources. State lives in RocksDB under the checkpoint folder, so it is not
bounded by executor memory and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidings.operators.learning import (DEFAULT_WEIGHT, SIGNAL_FEATURES, SOURCE_HIGH, SOURCE_HIGH_WEIGHT, SOURCE_LOW,
                                        SOURCE_LOW_WEIGHT, SOURCE_MIN_SEEN, STORED_STATE, outcome_columns)
from tidings.streaming.ingest import _batch_folder, store_batch, trigger_kwargs
from tidings.streaming.state import OUT_FIELDS, fold

DELAY = "30 days"
DAY_MS = 86_400_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State stores of queries started from now on (the processors need it)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _dated(stream: DataFrame, day: str, delay: str) -> DataFrame:
    """``event_ts``, midnight of a date column, as the event time."""
    return stream.where(F.col(day).isNotNull()).withColumn("event_ts", F.col(day).cast("timestamp")) \
        .withWatermark("event_ts", delay)


# ---------------------------------------------------------------- R6

def resolution_stream(log: DataFrame, returns: DataFrame, resolved: DataFrame | None = None,
                      delay: str = DELAY, flat: float = 0.3) -> DataFrame:
    """Outcomes of a stream of logged predictions and a stream of actual
    returns (news_date, actual_pct_change).

    Each prediction leaves once: with its outcome as soon as both sides are
    there, or unresolved (NULL outcome columns) once the lateness bound has
    passed. Unknown (NULL) returns are not returns; repeated returns of a day
    count once. Predictions dated in ``resolved`` are left out."""
    p = _dated(log, "news_date", delay)
    if resolved is not None:
        p = p.join(resolved.select("date"), "date", "left_anti")
    r = _dated(returns.where(F.col("actual_pct_change").isNotNull()), "news_date", delay) \
        .select("event_ts", "actual_pct_change").dropDuplicatesWithinWatermark(["event_ts"])
    both = p.join(r.select(F.col("event_ts").alias("due_ts"), "actual_pct_change"),
                  F.col("event_ts") == F.col("due_ts"), "left_outer")
    return both.select(*outcome_columns(flat))


def resolution_job(log: DataFrame, returns: DataFrame, sink: str, checkpoint: str, resolved: DataFrame | None = None,
                   delay: str = DELAY, once: bool = True, every: str = "1 day") -> StreamingQuery:
    """Stores each batch of ``resolution_stream``; rows without an
    ``actual_direction`` ended unresolved."""
    return (resolution_stream(log, returns, resolved, delay).writeStream.outputMode("append")
            .foreachBatch(lambda b, e: store_batch(b, sink, e)).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(once, every)).start())


# ---------------------------------------------------------------- R7, R8

class DatedFold(StatefulProcessor):
    """A fold in order of days over (day, correct) rows of one key. A row's
    day is not before its event time."""

    def __init__(self, schema: str, initial: tuple, step: Callable, rows: Callable, stored: list[str]):
        self.schema, self.initial, self.step, self.rows, self.stored = schema, initial, step, rows, stored

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)
        self.waiting = handle.getMapState("waiting", "day int", "wrong long, right long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        held = [None if pd.isna(row[c]) else row[c] for c in self.stored]
        self.state.update(tuple(d if v is None else type(d)(v) if d is not None else float(v)
                                for v, d in zip(held, self.initial)) + self.initial[len(held):])

    def _now(self) -> tuple:
        return tuple(self.state.get()) if self.state.exists() else self.initial

    def _fold(self, state: tuple, days: list) -> tuple[tuple, list]:
        """The state after the days, wrong outcomes of a day first, and every (day, state) on the way."""
        way = []
        for day, (wrong, right) in sorted(days):
            for correct in [0] * int(wrong) + [1] * int(right):
                state = self.step(state, correct)
                way.append((day, state))
        return state, way

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new: dict = {}
        for batch in rows:
            for day, correct in zip(batch["day"].tolist(), batch["correct"].tolist()):
                counts = new.setdefault(day, [0, 0])
                counts[int(correct)] += 1
        for day, (wrong, right) in new.items():
            if self.waiting.containsKey((day,)):
                held = self.waiting.getValue((day,))
                wrong, right = wrong + held[0], right + held[1]
            else:
                self.handle.registerTimer(day * DAY_MS + 1)
            self.waiting.updateValue((day,), (wrong, right))
        yield self.rows(key, *self._fold(self._now(), [(k[0], v) for k, v in self.waiting.iterator()]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No row of the timer's day or an earlier one can come any more."""
        last = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS
        days = [(k[0], v) for k, v in self.waiting.iterator() if k[0] <= last]
        state, _ = self._fold(self._now(), days)
        self.state.update(state)
        for day, _ in days:
            self.waiting.removeKey((day,))
        return iter(())

    def close(self) -> None:
        pass


def _folded(outcomes: DataFrame, keys: list[str], processor: DatedFold, schema: str, delay: str,
            stored: DataFrame | None) -> DataFrame:
    use_rocksdb(outcomes.sparkSession)
    rows = _dated(outcomes.where(F.col("correct").isNotNull()), "date", delay)
    held = stored.select(*keys, *processor.stored).groupBy(*keys) if stored is not None else None
    return rows.select(*keys, "event_ts", F.unix_date("date").alias("day"), "correct").groupBy(*keys).transformWithStateInPandas(
        processor, schema, "Append", "EventTime", initialState=held)


WEIGHT_STATE = "w double, cw int, cc int, wa int, ca int, pd double, drift double, n long"
WEIGHT_ROW = ("current_weight double, consecutive_wrong int, consecutive_correct int, wrong_since_adjustment int, "
              "correct_since_adjustment int, pre_decay_weight double, drift double, n_outcomes long")


def weight_state_stream(outcomes: DataFrame, keys: list[str], stored: DataFrame | None = None, delay: str = DELAY,
                        signal_col: str = "signal", signals=tuple(SIGNAL_FEATURES)) -> DataFrame:
    """The weight state of each key with new outcomes (keys..., date,
    correct), from the ``stored`` state; keys are strings. Outcomes of NULL or
    unknown signals are skipped."""
    def one(key: tuple, state: tuple, way: list) -> pd.DataFrame:
        return pd.DataFrame([dict(zip(keys, key)) | dict(zip(OUT_FIELDS, state))])
    processor = DatedFold(WEIGHT_STATE, (DEFAULT_WEIGHT, 0, 0, 0, 0, None, 0.0, 0), lambda s, ok: fold(s, [ok]), one,
                          list(STORED_STATE))
    schema = ", ".join(f"{k} string" for k in keys) + ", " + WEIGHT_ROW
    return _folded(outcomes.where(F.col(signal_col).isin(list(signals))), keys, processor, schema, delay, stored)


def weight_state_job(outcomes: DataFrame, keys: list[str], sink: str, checkpoint: str, stored: DataFrame | None = None,
                     delay: str = DELAY, once: bool = True, every: str = "1 day", **options) -> StreamingQuery:
    """Stores the states that each batch changes; the stored states come
    first, so ``latest_rows`` gives every key's weight, judged or not."""
    if stored is not None:
        seed = stored.select(*keys, *STORED_STATE).withColumns({"drift": F.lit(0.0), "n_outcomes": F.lit(0).cast("long")})
        seed.write.mode("ignore").parquet(_batch_folder(sink, -1))
    states = weight_state_stream(outcomes, keys, stored, delay, **options)
    return (states.writeStream.outputMode("append").foreachBatch(lambda b, e: store_batch(b, sink, e))
            .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(once, every)).start())


def _credit(state: tuple, correct: int) -> tuple:
    """(seen, correct, weight) after one more outcome of a source."""
    seen, right, weight = state[0] + 1, state[1] + correct, state[2]
    if seen >= SOURCE_MIN_SEEN and right / seen < SOURCE_LOW:
        weight = SOURCE_LOW_WEIGHT
    elif seen >= SOURCE_MIN_SEEN and right / seen > SOURCE_HIGH:
        weight = SOURCE_HIGH_WEIGHT
    return seen, right, weight


def credibility_stream(outcomes: DataFrame, routed: DataFrame, index_ticker: str, ts: str = "published_at",
                       delay: str = DELAY) -> DataFrame:
    """(source_name, date, running totals, accuracy, weight) of every source
    with an index headline on an outcome's news day; both inputs are streams.
    A row is emitted again when an earlier day's outcome arrives within the
    bound: the last version counts (``latest_rows`` by source and date).

    Running totals follow the outcomes' own dates, none of which is before its
    news day."""
    days = _dated(routed.where((F.col("ticker") == index_ticker) & F.col("source").isNotNull())
                  .select("source", F.to_date(F.col(ts)).alias("news_date")), "news_date", delay) \
        .select("source", "event_ts").dropDuplicatesWithinWatermark(["source", "event_ts"])
    o = _dated(outcomes.where(F.col("correct").isNotNull()), "news_date", delay) \
        .select(F.col("event_ts").alias("due_ts"), "date", "correct")
    both = days.join(o, F.col("event_ts") == F.col("due_ts"))

    def rows(key: tuple, state: tuple, way: list) -> pd.DataFrame:
        return pd.DataFrame({
            "source_name": [key[0]] * len(way), "date": [pd.Timestamp(d * DAY_MS, unit="ms").date() for d, _ in way],
            "total_predictions": [s[0] for _, s in way], "correct_predictions": [s[1] for _, s in way],
            "accuracy_rate": [s[1] / s[0] for _, s in way], "current_weight": [s[2] for _, s in way]})
    processor = DatedFold("seen long, right long, weight double", (0, 0, DEFAULT_WEIGHT), _credit, rows, [])
    use_rocksdb(outcomes.sparkSession)
    return both.select("source", "event_ts", F.unix_date("date").alias("day"), "correct").groupBy("source") \
        .transformWithStateInPandas(
        processor, "source_name string, date date, total_predictions long, correct_predictions long, "
        "accuracy_rate double, current_weight double", "Append", "EventTime")


def credibility_state_job(outcomes: DataFrame, routed: DataFrame, index_ticker: str, sink: str, checkpoint: str,
                          delay: str = DELAY, once: bool = True, every: str = "1 day") -> StreamingQuery:
    """Stores the rows of each batch of ``credibility_stream``."""
    rows = credibility_stream(outcomes, routed, index_ticker, delay=delay)
    return (rows.writeStream.outputMode("append").foreachBatch(lambda b, e: store_batch(b, sink, e))
            .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(once, every)).start())
