from tidings.sources import tables as tb


def test_append_new_edges(spark):
    target = spark.createDataFrame([(1, "stored")], "id int, headline string")
    batch = spark.createDataFrame([(2, "dup"), (3, "dup"), (4, "stored"), (5, "Stored"), (6, ""), (7, None)],
                                  "id int, headline string")
    new = sorted((r.id, r.headline) for r in tb.append_new(target, batch, "headline", ["id"]).collect())
    assert new == [(2, "dup"), (5, "Stored")]
    s = tb.ingest_stats(target, batch, "headline", ["id"]).first()
    assert (s.fetched, s.skipped, s.inserted, s.duplicates, s.total) == (6, 2, 2, 2, 3)


def test_upsert_insert_ignore_patch(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, ver int")
    u = spark.createDataFrame([(2, "B", 1), (3, "C", 1), (3, "C2", 2)], "k int, v string, ver int")
    assert sorted(tuple(r) for r in tb.upsert(t, u, ["k"], "ver").collect()) == [(1, "a", 0), (2, "B", 1),
                                                                                (3, "C2", 2)]
    assert sorted(tuple(r) for r in tb.insert_ignore(t, u, ["k"]).collect()) == [(1, "a", 0), (2, "b", 0),
                                                                                (3, "C", 1)]
    p = spark.createDataFrame([(2, "P")], "k int, v string")
    assert sorted(tuple(r) for r in tb.update_columns(t, p, ["k"], ["v"]).collect()) == [(1, "a", 0), (2, "P", 0)]


def test_first_by_key_hot_key(spark):
    rows = [(i, "same") for i in range(2000)] + [(5000, "other")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = sorted(tuple(r) for r in tb.first_by_key(df, ["text"], ["id"]).collect())
    assert got == [(0, "same"), (5000, "other")]
