"""Outcomes, weights and credibility on streams with late, early and shuffled files."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidings.operators import learning as lr
from tidings.streaming import ingest as sm
from tidings.streaming import resolution as rs

LOG = ("date date, prediction string, top_signals array<struct<signal:string,contribution:double>>, similar array<struct<"
       "headline:string,date:string,similarity:double,next_session_return:double,outcome:string>>, news_date date")
RETURNS = "news_date date, actual_pct_change double"
START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def predicted(n, what="UP"):
    return (day(n + 1), what, [("sp500", 1.0)], [], day(n))


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(autouse=True)
def state_store(spark):
    """The provider of the other streaming tests is their own choice."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_late_predictions_and_early_returns(spark, tmp_path):
    log, returns, sink, ckpt = (f"{tmp_path}/{x}" for x in ("log", "returns", "sink", "ckpt"))

    def run():
        rs.resolution_job(stream(spark, LOG, log), stream(spark, RETURNS, returns), sink, ckpt, delay="10 days").awaitTermination()
        return {r.news_date: (r.predicted, r.actual_direction, r.correct) for r in spark.read.parquet(sink).collect()}
    put(spark, [predicted(1), predicted(2, "DOWN")], LOG, log)
    put(spark, [(day(1), 2.0), (day(3), -1.0), (day(4), None), (None, 5.0)], RETURNS, returns)
    assert run() == {day(1): ("UP", "UP", 1)}
    put(spark, [predicted(3), predicted(4)], LOG, log)      # logged after the job has started, its return long there
    put(spark, [(day(2), -3.0), (day(2), -3.0), (day(4), 0.1)], RETURNS, returns)  # late, and twice
    got = run()
    assert got == {day(1): ("UP", "UP", 1), day(2): ("DOWN", "DOWN", 1), day(3): ("UP", "DOWN", 0), day(4): ("UP", "FLAT", 0)}
    assert spark.read.parquet(sink).count() == 4


def test_unresolved_predictions_leave_when_the_bound_has_passed(spark, tmp_path):
    log, returns, sink, ckpt = (f"{tmp_path}/{x}" for x in ("log", "returns", "sink", "ckpt"))
    put(spark, [predicted(1)], LOG, log)
    put(spark, [(day(2), 1.0)], RETURNS, returns)
    job = lambda: rs.resolution_job(stream(spark, LOG, log), stream(spark, RETURNS, returns), sink, ckpt, delay="3 days")
    job().awaitTermination()
    put(spark, [predicted(9)], LOG, log)
    put(spark, [(day(9), 1.0)], RETURNS, returns)
    job().awaitTermination()
    job().awaitTermination()
    got = {r.news_date: (r.actual_direction, r.correct, r.judged_signal) for r in spark.read.parquet(sink).collect()}
    assert got == {day(1): (None, None, None), day(9): ("UP", 1, "sp500")}


def outcomes(rnd, n=60):
    rows = [(f"e{rnd.randint(0, 2)}", rnd.choice(["sp500", "crude_oil", "sector", None]), day(i // 2), rnd.randint(0, 1))
            for i in range(2 * n)]
    return rows, "name string, signal string, date date, correct int"


STORED = ("name string, signal string, current_weight double, consecutive_wrong int, consecutive_correct int, "
          "wrong_since_adjustment int, correct_since_adjustment int, pre_decay_weight double")


def test_weights_of_shuffled_files_equal_the_batch_fold(spark, tmp_path):
    rows, schema = outcomes(random.Random(6))
    stored = spark.createDataFrame([("e0", "sp500", 0.7, 1, 0, 2, 3, 1.4), ("e9", "usdinr", 1.3, 2, 0, 4, 0, None)], STORED)
    src, sink, ckpt = (f"{tmp_path}/{x}" for x in ("src", "sink", "ckpt"))
    parts = [rows[i:i + 30] for i in range(0, len(rows), 30)]
    for run in ([1, 0], [3, 2]):  # the later file first; then the job is restarted
        for i in run:
            put(spark, parts[i], schema, src)
        rs.weight_state_job(stream(spark, schema, src), ["name", "signal"], sink, ckpt, stored, delay="35 days").awaitTermination()
    cols = ["name", "signal", "current_weight", "consecutive_wrong", "consecutive_correct", "wrong_since_adjustment",
            "correct_since_adjustment", "pre_decay_weight", "drift", "n_outcomes"]
    got = sm.latest_rows(spark, sink, ["name", "signal"]).select(cols).collect()
    want = lr.adjust_weights(spark.createDataFrame(rows, schema), ["name", "signal"], stored=stored).select(cols).collect()
    rounded = lambda rs_: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rs_)
    key = lambda r: (r[0], r[1])
    assert sorted(rounded(got), key=key) == sorted(rounded(want), key=key)
    assert ("e9", "usdinr") in {(r.name, r.signal) for r in got}  # not judged, not lost


def test_finished_days_leave_the_state(spark, tmp_path):
    src, sink, ckpt = (f"{tmp_path}/{x}" for x in ("src", "sink", "ckpt"))
    schema = "name string, signal string, date date, correct int"
    for at in (0, 20, 40):
        put(spark, [("e", "sp500", day(at + i), 0) for i in range(3)], schema, src)
    rs.weight_state_job(stream(spark, schema, src), ["name", "signal"], sink, ckpt, delay="5 days").awaitTermination()
    assert sm.latest_rows(spark, sink, ["name", "signal"]).first().n_outcomes == 9
    # the map holds only days that the watermark (newest day less 5) has not passed
    waiting = (spark.read.format("statestore").option("path", ckpt).option("stateVarName", "waiting").load())
    left = sorted(r[0] for r in waiting.select("user_map_key.day").collect())
    assert left == [(day(40 + i) - dt.date(1970, 1, 1)).days for i in range(3)]


def test_credibility_of_shuffled_files_equals_the_batch(spark, tmp_path):
    rnd = random.Random(7)
    results = [(day(n), day(n + 1), rnd.randint(0, 1)) for n in range(50)]
    heads = [(rnd.choice(["I", "I", "X"]), rnd.choice(["a", "b", None]), dt.datetime.combine(day(n), dt.time(rnd.randint(0, 23))))
             for n in range(50) for _ in range(4)]
    o_schema, r_schema = "news_date date, date date, correct int", "ticker string, source string, published_at timestamp"
    osrc, rsrc, sink, ckpt = (f"{tmp_path}/{x}" for x in ("o", "r", "sink", "ckpt"))
    for i in (1, 0, 2):
        put(spark, results[i * 17:(i + 1) * 17], o_schema, osrc)
    for i in (0, 2, 1):
        put(spark, heads[i * 70:(i + 1) * 70], r_schema, rsrc)
    rs.credibility_state_job(stream(spark, o_schema, osrc), stream(spark, r_schema, rsrc), "I", sink, ckpt,
                             delay="60 days").awaitTermination()
    got = sm.latest_rows(spark, sink, ["source_name", "date"])
    want = lr.source_credibility(spark.createDataFrame(results, o_schema), spark.createDataFrame(heads, r_schema), "I")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert want.where(F.col("total_predictions") >= 20).count() > 0


def test_stored_keys_without_outcomes_stay(spark):
    stored = spark.createDataFrame([("a", "sp500", 0.7, 1, 0, 2, 3, 1.4), ("b", "usdinr", 1.3, 2, 0, 4, 0, None)], STORED)
    new = spark.createDataFrame([("a", "sp500", day(1), 1)], "name string, signal string, date date, correct int")
    got = {r.name: r for r in lr.adjust_weights(new, ["name", "signal"], stored=stored).collect()}
    assert got["b"].current_weight == 1.3 and got["b"].n_outcomes == 0 and got["b"].wrong_since_adjustment == 4
    assert got["a"].n_outcomes == 1
