import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidings.operators import learning as lr
from tidings.operators import series as ser
from tidings.operators import views as vw
from tidings.sources import feeds as fd
from tidings.sources import tables as tb


def test_wide_prices_and_dimension_csv(spark):
    d = tempfile.mkdtemp(prefix="tidings-test-")
    p = os.path.join(d, "prices.csv")
    with open(p, "w") as f:
        f.write("Date,TCS,Infosys\n2024-01-01,10.0,\n2024-01-02,11.0,20.0\n")
    long = sorted(tuple(r) for r in fd.read_prices_wide(spark, p).collect())
    assert long == [("Infosys", dt.date(2024, 1, 2), 20.0), ("TCS", dt.date(2024, 1, 1), 10.0),
                    ("TCS", dt.date(2024, 1, 2), 11.0)]
    q = os.path.join(d, "dim.csv")
    with open(q, "w") as f:
        f.write('ticker,name,sector\nDRREDDY,"Dr Reddy\'s, Ltd",Pharma\n')
    assert fd.read_sector_map(spark, q).first().name == "Dr Reddy's, Ltd"
    u = fd.union_series([spark.createDataFrame([("a", 1.0)], "name string, close double"),
                         spark.createDataFrame([("b",)], "name string")])
    assert u.count() == 2


def test_flatten_defaults(spark):
    schema = ("topic string, articles array<struct<title:string,source:struct<name:string>,publishedAt:string,"
              "url:string,description:string>>, _corrupt_record string")
    df = spark.createDataFrame([("T", [("h1", None, None, None, None),
                                       (None, ("S",), "2024-01-01T00:00:00Z", "u", "d")], None)], schema)
    got = sorted(tuple(r) for r in fd.flatten_articles(df).collect())
    assert got == [("T", "", "S", "2024-01-01T00:00:00Z", "u", "d"), ("T", "h1", "Unknown", "", "", "")]


def test_schema_evolution_template_and_domain(spark):
    df = spark.createDataFrame([(" Positive ", "h", "s", "t", None)],
                               "label string, headline string, source string, topic string, published_at timestamp")
    e = tb.ensure_columns(df, {"sentiment_confidence": ("double", None), "label": ("string", "x")})
    assert "sentiment_confidence" in e.columns and e.first().label == " Positive "
    assert tb.labeling_template(df).first().sentiment_label == ""
    assert vw.normalize_label(df, "label", ["positive"]).first().label == "positive"
    with pytest.raises(Exception):
        vw.assert_domain(df, "label", ["positive"]).collect()


def test_complete_dates_and_flatten_dim(spark):
    rows = [("A", dt.date(2024, 1, 1), 1.0), ("B", dt.date(2024, 1, 1), 2.0), ("A", dt.date(2024, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "name string, date date, close double")
    assert {r.date for r in ser.complete_dates(df, "name", "date", "close").collect()} == {dt.date(2024, 1, 1)}
    nested = spark.createDataFrame([({"IT": {"TCS.NS": "TCS"}, "Banking": {"SBIN.NS": "SBI"}},)],
                                   "m map<string,map<string,string>>")
    got = sorted(tuple(r) for r in vw.flatten_dim(nested, "m").collect())
    assert got == [("SBIN.NS", "SBI", "Banking"), ("TCS.NS", "TCS", "IT")]


def test_latest_run_and_snapshot(spark):
    m = spark.createDataFrame([("2024-01-01", 0.4), ("2024-01-03", 0.5), ("2024-01-02", 0.6)],
                              "run_at string, acc double")
    assert vw.latest_run(m).first().acc == 0.5
    w = spark.createDataFrame([("d", "sentiment", 1.0), ("d", "sp500", 0.5)], "day string, s string, w double")
    snap = lr.snapshot_map(w, ["day"], "s", "w").first().snapshot
    assert snap == {"sentiment": 1.0, "sp500": 0.5}
    assert F is not None


def test_write_table_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tidings-test-")
    df = spark.createDataFrame([("a", "x, \"y\"", 1)], "k string, v string, part int")
    tb.write_table(df, os.path.join(d, "p"), "parquet", ["part"])
    assert spark.read.parquet(os.path.join(d, "p")).first().v == 'x, "y"'
    tb.write_table(df.drop("part"), os.path.join(d, "c"), "csv")
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(d, "c")).first()
    assert back.v == 'x, "y"'
