"""The digest index: exact, few files read, compaction in tiers, reruns."""
import os
import random

import pandas as pd
from pyspark.sql import functions as F

from tidings.streaming import digests as dg


def sha(spark, words):
    return spark.createDataFrame([(w,) for w in words], "w string").select(F.sha2("w", 256).alias("digest"))


def test_filters_never_miss(spark):
    words = pd.Series([f"{random.Random(i).getrandbits(256):064x}" for i in range(3000)])
    bits = dg.bloom(words[:1000])
    assert dg.may_hold(bits, words[:1000]).all()
    assert dg.may_hold(bits, words[1000:]).sum() <= 5  # rate 1e-4
    assert not dg.may_hold(dg.bloom(words[:0]), words).any()


def test_lookups_are_exact_and_read_few_files(spark, tmp_path):
    index = dg.DigestIndex(spark, str(tmp_path / "i"), buckets=32, fan=100)
    for e in range(6):
        index.add(sha(spark, [f"{e}-{i}" for i in range(400)]), e)
    stored = [f for d, _, fs in os.walk(f"{tmp_path}/i/digests") for f in fs if f.endswith(".parquet")]
    assert len(stored) == 6 * 32
    asked = ["2-7", "4-399", "new", "newer"]
    folders = index.candidates(sha(spark, asked))
    assert 2 <= len(folders) <= 6  # those of the two stored digests, hardly more
    left = index.unseen(sha(spark, asked))
    want = {r.digest for r in sha(spark, ["new", "newer"]).collect()}
    assert {r.digest for r in left.collect()} == want
    assert index.candidates(sha(spark, ["never", "seen"])) == []


def test_tiers_bound_the_live_runs(spark, tmp_path):
    index = dg.DigestIndex(spark, str(tmp_path / "i"), buckets=4, fan=3)
    for e in range(10):
        index.add(sha(spark, [str(e)]), e)
        assert len(index.live()) <= 5
    assert sorted(n for _, n in index.live()) == [0, 2]  # 9 batches in one run, 1 beside it
    everything = sha(spark, [str(e) for e in range(12)])
    assert index.unseen(everything).count() == 2


def test_a_batch_that_runs_again_does_not_see_itself(spark, tmp_path):
    index = dg.DigestIndex(spark, str(tmp_path / "i"), buckets=4, fan=2)
    for e in range(3):
        index.add(sha(spark, [str(e)]), e)
    again = sha(spark, ["0", "2"])
    assert index.unseen(again, before=2).count() == 1  # 2 is its own
    index.add(sha(spark, ["2"]), 2)
    assert index.unseen(sha(spark, ["0", "1", "2", "3"])).count() == 1


def test_first_row_per_key(spark, tmp_path):
    index = dg.DigestIndex(spark, str(tmp_path / "i"), buckets=4)
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("", 1), (None, 1), ("b", 1)], "text string, n int")
    first = lambda d: d.groupBy("digest").agg(F.min("n").alias("n"))
    new = dg.append_unseen(index, batch, "text", 0, first)
    assert sorted(r.n for r in new.collect()) == [1, 1]
