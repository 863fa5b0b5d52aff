"""Bucketed tables: what a merge touches, runs again, and gives."""
import os

import pytest
from pyspark.sql import functions as F

from tidings.sources.buckets import BucketedTable
from tidings.sources.tables import upsert

SCHEMA = "k long, v string, n long"


@pytest.fixture
def table(spark, tmp_path):
    t = BucketedTable(str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ("k",), 32)
    t.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).cast("long").alias("n")))
    return t


def folders(t, commit):
    path = f"{t.path}/data/commit={commit}"
    return [x for x in os.listdir(path) if x.startswith("bucket=")]


def test_upsert_touches_its_keys_buckets_alone(spark, table):
    before = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{table.path}/data/commit=0")
              for f in fs}
    new = spark.createDataFrame([(3, "new", 1), (2000, "new", 1), (3, "newer", 2)], SCHEMA)
    assert table.upsert(new, "n") == 1
    assert len(folders(table, 0)) == 32 and 1 <= len(folders(table, 1)) <= 2
    assert before == {p: os.path.getmtime(p) for p in before}  # nothing else is written
    now = table.read(spark)
    want = upsert(table.read(spark, 0), new, ["k"], "n")
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, want.collect()))
    assert now.where("k = 3").first().v == "newer" and now.count() == 1001
    read = {p.rsplit("commit=", 1)[1].split("/")[0] for p in now.inputFiles()}
    assert read == {"0", "1"}


def test_a_merge_that_runs_again_does_nothing(spark, table):
    new = spark.createDataFrame([(3, "new", 1)], SCHEMA)
    assert table.upsert(new, "n", commit=1) == 1
    first = sorted(table.read(spark).inputFiles())
    assert table.upsert(spark.createDataFrame([(3, "again", 9)], SCHEMA), "n", commit=1) == 1
    assert sorted(table.read(spark).inputFiles()) == first and table.read(spark).where("k = 3").first().v == "new"


def test_a_merge_that_failed_is_invisible_and_repeats(spark, table):
    def fails(t, u):
        return u.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    new = spark.createDataFrame([(3, "new", 1)], SCHEMA)
    with pytest.raises(Exception, match="lost"):
        table.merge(new, fails, 1)
    assert table.last_commit(spark) == 0 and table.read(spark).where("v <> 'old'").count() == 0
    assert table.upsert(new, "n", 1) == 1 and table.read(spark).where("v = 'new'").count() == 1


def test_insert_ignore_and_patch(spark, table):
    table.insert_ignore(spark.createDataFrame([(3, "x", 5), (None, "null key", 1), (5000, "b", 2), (5000, "a", 1)], SCHEMA))
    got = {r.k: (r.v, r.n) for r in table.read(spark).where("n <> 0 OR k = 3").collect()}
    assert got == {3: ("old", 0), None: ("null key", 1), 5000: ("a", 1)}
    table.patch(spark.createDataFrame([(3, "patched", None), (9999, "no such key", 1)], SCHEMA), ["v", "n"])
    assert table.read(spark).where("k = 3").first() == (3, "patched", 0) and table.read(spark).where("k = 9999").isEmpty()


def test_empty_tables(spark, tmp_path):
    t = BucketedTable(str(tmp_path / "e"), spark.createDataFrame([], SCHEMA).schema, ("k",), 4)
    none = spark.createDataFrame([], SCHEMA)
    t.create(none)
    assert t.read(spark).count() == 0 and t.upsert(none, "n") == 1
    t.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), "n")
    assert t.read(spark).count() == 1 and t.last_commit(spark) == 2
