import datetime as dt

from pyspark.sql import functions as F

from tidings.functions.columns import day_of_week, label_from_return, pct, scaled_conf, sentiment_sign, to_utc_day


def test_label_from_return_edges(spark):
    rows = [(0.3,), (-0.3,), (0.3000001,), (-0.3000001,), (0.0,), (None,)]
    df = spark.createDataFrame(rows, "r double")
    got = [r[0] for r in df.select(label_from_return("r")).collect()]
    assert got == ["FLAT", "FLAT", "UP", "DOWN", "FLAT", None]


def test_sentiment_sign_and_pct(spark):
    df = spark.createDataFrame([("positive", 2.0, 1.0), ("negative", 1.0, 0.0), ("neutral", None, 2.0),
                                ("other", 3.0, 2.0)], "l string, a double, b double")
    got = df.select(sentiment_sign("l").alias("s"), pct("a", "b").alias("p")).collect()
    assert [r.s for r in got] == [1, -1, 0, None]
    assert [r.p for r in got] == [100.0, None, None, 50.0]


def test_dates_and_conf(spark):
    df = spark.createDataFrame([("2024-01-01T23:30:00Z", 7.5), ("2024-01-07T00:10:00+00:00", -1.0)],
                               "ts string, x double")
    got = df.select(to_utc_day("ts").alias("d"), day_of_week(to_utc_day("ts")).alias("w"),
                    scaled_conf("x", 5.0).alias("c")).collect()
    assert got[0].d == dt.date(2024, 1, 1) and got[0].w == 0  # Monday = 0
    assert got[1].d == dt.date(2024, 1, 7) and got[1].w == 6
    assert got[0].c == 1.0 and got[1].c == 0.2
    assert df.select(F.lit(1)).count() == 2
