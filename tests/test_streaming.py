import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidings.operators import learning as lr
from tidings.sources import feeds as fd
from tidings.streaming import ingest as sm


def _feed(folder, name, titles):
    os.makedirs(f"{folder}/topic=t", exist_ok=True)
    with open(f"{folder}/topic=t/{name}.json", "w") as f:
        for t in titles:
            f.write(json.dumps({"articles": [{"title": t, "publishedAt": "2024-01-01T00:00:00Z"}]}) + "\n")


def _run(spark, base):
    stream = sm.feed_stream(spark, f"{base}/src", max_files=1)
    sm.append_batches(stream, f"{base}/sink", "headline", ["published_at", "source"], f"{base}/ckpt").awaitTermination()
    return sorted(r.headline for r in spark.read.parquet(f"{base}/sink").select("headline").collect())


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    base = str(tmp_path)
    _feed(f"{base}/src", "1", ["a", "b", "a", ""])
    _feed(f"{base}/src", "2", ["b", "c"])
    assert _run(spark, base) == ["a", "b", "c"]
    _feed(f"{base}/src", "3", ["c", "d", "a"])
    assert _run(spark, base) == ["a", "b", "c", "d"]
    # the last batch was written but not committed: it runs again
    last = max(int(x) for x in os.listdir(f"{base}/ckpt/commits") if x.isdigit())
    for x in (f"{base}/ckpt/commits/{last}", f"{base}/ckpt/commits/.{last}.crc"):
        if os.path.exists(x):
            os.remove(x)
    assert _run(spark, base) == ["a", "b", "c", "d"]


def test_batches_count_themselves(spark, tmp_path):
    base = str(tmp_path)
    _feed(f"{base}/src", "1", ["a", "b", "a", ""])
    _run(spark, base)
    _feed(f"{base}/src", "2", ["b", "c", "", ""])
    _run(spark, base)
    got = {r.batch: (r.fetched, r.skipped, r.inserted, r.duplicates) for r in sm.ingest_counters(spark, f"{base}/sink").collect()}
    assert got == {0: (4, 1, 2, 1), 1: (4, 2, 1, 1)}


def test_batches_without_new_rows_count_themselves(spark, tmp_path):
    base = str(tmp_path)
    for name, titles in [("1", [""]), ("2", ["a"]), ("3", ["a", "a"]), ("4", ["", ""]), ("5", ["b"])]:
        _feed(f"{base}/src", name, titles)
        got = _run(spark, base)
    assert got == ["a", "b"]
    got = {r.batch: (r.fetched, r.skipped, r.inserted, r.duplicates) for r in sm.ingest_counters(spark, f"{base}/sink").collect()}
    assert got == {0: (1, 1, 0, 0), 1: (1, 0, 1, 0), 2: (2, 0, 0, 2), 3: (2, 2, 0, 0), 4: (1, 0, 1, 0)}


def test_large_topics_are_written_in_parts(spark):
    rows = [(i, "en", "x" * 100) for i in range(200)] + [(i, None, "y" * 100) for i in range(5)] + [(7, "fr", None), (None, "de", "z")]
    df = spark.createDataFrame(rows, "id long, topic string, headline string")
    dealt = fd.in_parts(df, "topic", "headline", part_bytes=2000)
    assert sorted(dealt.drop("_part").collect(), key=str) == sorted(df.collect(), key=str)
    parts = {r.topic: (r.parts, r.most) for r in dealt.groupBy("topic", "_part").count().groupBy("topic")
             .agg(F.count(F.lit(1)).alias("parts"), F.max("count").alias("most")).collect()}
    assert parts["en"][0] == 10 and parts["en"][1] < 50
    assert parts[None] == (1, 5) and parts["fr"] == parts["de"] == (1, 1)


def test_parts_grow_with_the_rows(spark):
    df = spark.createDataFrame([("x" * 100,)] * 50 + [(None,)], "body string")
    assert fd.part_count(df, "body", least=2, part_bytes=1000) == 5
    assert fd.part_count(df, "body", least=2) == fd.part_count(df.limit(0), "body", least=2) == 2


def test_watermark_drops_repeats(spark, tmp_path):
    rows = [("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 2)), ("b", dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "headline string, published_ts timestamp")
    df.write.parquet(f"{tmp_path}/src")
    once = sm.dedup_within_watermark(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/src"))
    sm.on_each_batch(once, lambda b, e: sm.store_batch(b, f"{tmp_path}/sink", e), f"{tmp_path}/ckpt").awaitTermination()
    assert sorted(r.headline for r in spark.read.parquet(f"{tmp_path}/sink").collect()) == ["a", "b"]


def test_windows_are_upserted(spark, tmp_path):
    schema = "topic string, published_ts timestamp, sentiment_label string, sentiment_confidence double"
    for i, day in enumerate((1, 1, 2)):
        spark.createDataFrame([("t", dt.datetime(2024, 1, day, 5 + i), "positive", 0.5)], schema).coalesce(1) \
            .write.mode("append").parquet(f"{tmp_path}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
    sm.upsert_each_batch(sm.daily_sentiment_stream(stream, "topic"), f"{tmp_path}/sink", f"{tmp_path}/ckpt").awaitTermination()
    got = {r.window.start.day: r.n_headlines for r in sm.latest_rows(spark, f"{tmp_path}/sink", ["window", "topic"]).collect()}
    assert got == {1: 2, 2: 1}


def test_outcomes_are_resolved_once(spark, tmp_path):
    sig = [("sp500", 1.0)]
    log = spark.createDataFrame(
        [(dt.date(2024, 1, d + 1), "UP", sig, [], dt.date(2024, 1, d)) for d in range(1, 6)],
        "date date, prediction string, top_signals array<struct<signal:string,contribution:double>>, similar array<struct<"
        "headline:string,date:string,similarity:double,next_session_return:double,outcome:string>>, news_date date")
    returns = [(dt.date(2024, 1, d), r) for d, r in [(1, 2.0), (2, -1.0), (3, None), (3, 0.1), (4, 1.0), (4, 1.0)]]
    schema = "news_date date, actual_pct_change double"
    for row in returns:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
    done = log.where(F.col("news_date") == F.lit("2024-01-01").cast("date"))
    sm.resolve_job(stream, log, f"{tmp_path}/sink", f"{tmp_path}/ckpt", done).awaitTermination()
    got = {r.news_date.day: r.correct for r in spark.read.parquet(f"{tmp_path}/sink").collect()}
    assert got == {2: 0, 3: 0, 4: 1}
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 3


def test_retrain_checks_follow_the_history(spark, tmp_path):
    schema = "date date, correct int, judged_signal string, news_date date"
    for d in range(1, 4):
        spark.createDataFrame([(dt.date(2024, 1, d), 0, "sp500", dt.date(2024, 1, d))], schema).coalesce(1) \
            .write.mode("append").parquet(f"{tmp_path}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
    labeled = spark.createDataFrame([(3,)], "total_labeled long")
    sm.retrain_job(stream, labeled, None, f"{tmp_path}/sink", f"{tmp_path}/ckpt").awaitTermination()
    rows = {r.batch: r.should_retrain for r in spark.read.parquet(f"{tmp_path}/sink").collect()}
    assert list(rows[k] for k in sorted(rows)) == [0, 0, 1]  # three wrong in a row: drift 0.5
    assert sm.latest_batch(spark, f"{tmp_path}/sink").first().should_retrain == 1


def test_signals_are_upserted_by_key(spark):
    schema = "date date, sector string, stock string, signal_type string, reasoning string, source_headline string, confidence double"
    day = dt.date(2024, 2, 1)
    old = spark.createDataFrame([(day, "IT", "TCS", "a", "x", None, 0.1), (day, "Air", None, "a", "x", None, 0.1)], schema)
    new = spark.createDataFrame([(day, "Air", None, "a", "y", None, 0.9), (dt.date(2024, 2, 2), "IT", "TCS", "a", "y", None, 0.5)], schema)
    got = {(r.date.day, r.sector): r.confidence for r in lr.upsert_signals(old, new).collect()}
    assert got == {(1, "IT"): 0.1, (1, "Air"): 0.9, (2, "IT"): 0.5}
