import datetime as dt
import math
import random

import numpy as np
import pytest

from tidings.operators import series as ser
from tidings.operators import similarity as sim


def test_rolling_needs_full_window(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), float((i * 7) % 13)) for i in range(95)]
    df = spark.createDataFrame(rows, "name string, date date, close double")
    r = {x.date: x.rolling_std for x in ser.rolling(df, "name", "date", "close", n=90, block=90).collect()}
    d = [rows[i][1] for i in range(95)]
    assert r[d[88]] is None and r[d[89]] is not None and r[d[90]] is not None
    assert abs(r[d[94]] - float(np.std([x[2] for x in rows[5:95]], ddof=1))) < 1e-9


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10]], "v double")
    h = {r.bin: r.n for r in ser.histogram(df, "v", 5).collect()}
    assert h[5] == 1 and sum(h.values()) == 5


def test_corr_matrix_pairwise_complete(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        for n in "ABC":
            if rnd.random() < 0.8:
                rows.append((n, dt.date(2024, 1, 1) + dt.timedelta(days=i), rnd.random()))
    df = spark.createDataFrame(rows, "name string, date date, ret double")
    got = {(r.name_a, r.name_b): r.corr for r in ser.corr_matrix(df, block=2, dates_per_part=16).collect()}
    by = {}
    for n, d, v in rows:
        by.setdefault(n, {})[d] = v
    for a, b in [("A", "B"), ("A", "C"), ("B", "C")]:
        common = sorted(set(by[a]) & set(by[b]))
        x = [by[a][d] for d in common]
        y = [by[b][d] for d in common]
        assert abs(got[(a, b)] - float(np.corrcoef(x, y)[0, 1])) < 1e-9
    assert abs(got[("A", "A")] - 1.0) < 1e-9


def test_similarity_small_corpus_and_copies(spark):
    q = spark.createDataFrame([(1, "rates rise again")], "qid long, text string")
    small = spark.createDataFrame([(i, f"doc number {i}") for i in range(4)], "did long, text string")
    assert sim.similar_docs(q, small, "qid", "text", "did", "text").count() == 0
    corpus = spark.createDataFrame([(1, "rates rise again"), (2, "bond yields fall"), (3, "equity markets"),
                                    (4, "oil prices"), (5, "gold rallies"), (6, "nothing shared here")],
                                   "did long, text string")
    r = sim.similar_docs(q, corpus, "qid", "text", "did", "text").collect()
    assert r[0].did == 1 and abs(r[0].similarity - 1.0) < 1e-12 and len(r) == 1


def test_idf_formula(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "alpha gamma"), (3, "alpha alpha delta")],
                                 "id long, text string")
    v = {r.term: r for r in sim.vocabulary(docs, "text").collect()}
    assert v["alpha"].cf == 4 and v["alpha"].df == 3
    assert abs(v["beta"].idf - (math.log(4 / 2) + 1)) < 1e-12


def test_top_k_per_group_salted(spark):
    rows = [("hot", i, float(i)) for i in range(5000)] + [("cold", i, float(-i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, id int, s double")
    from pyspark.sql import functions as F
    top = sim.top_k_per_group(df, ["g"], [F.col("s").desc(), F.col("id")], 3)
    got = sorted((r.g, r.id) for r in top.collect())
    assert got == [("cold", 0), ("cold", 1), ("cold", 2), ("hot", 4997), ("hot", 4998), ("hot", 4999)]


def test_returns_pad_and_none(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    rows = [("A", x, v) for x, v in zip(d, [10.0, 11.0, 12.0, 12.0, 6.0])]
    rows += [("B", d[1], 4.0), ("B", d[3], 5.0)]  # leading gap, gap in the middle, trailing gap
    df = spark.createDataFrame(rows, "name string, date date, close double")
    pad = {x.date: x.ret for x in ser.returns(df).where("name = 'B'").collect()}
    assert pad[d[0]] is None and pad[d[1]] is None and pad[d[2]] == 0.0
    assert abs(pad[d[3]] - 25.0) < 1e-12 and pad[d[4]] == 0.0
    none = {x.date: x.ret for x in ser.returns(df, fill="none").collect() if x.name == "B"}
    assert set(none) == set(d) and all(v is None for v in none.values())
    a = {x.date: x.ret for x in ser.returns(df, fill="none").collect() if x.name == "A"}
    assert abs(a[d[1]] - 10.0) < 1e-12 and abs(a[d[4]] + 50.0) < 1e-12


def test_similar_per_query_against_brute_force(spark):
    rnd = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9)))) for i in range(60)]
    asked = [(i, " ".join(rnd.choice(words) for _ in range(3))) for i in range(5)]
    n = len(docs)
    df = {w: sum(w in t.split() for _, t in docs) for w in words}

    def vec(t):
        v = np.array([t.split().count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in words])
        return v / np.linalg.norm(v)
    want = {(q, r): c for q, qt in asked for r, (_, c) in enumerate(sorted(
        (-round(float(vec(qt) @ vec(t)), 10), c) for c, t in docs if float(vec(qt) @ vec(t)) > 0)[:3], 1)}
    got = sim.similar_per_query(spark.createDataFrame(asked, "q long, text string"),
                                spark.createDataFrame(docs, "c long, text string").repartition(4), "q", "text", "c", "text")
    assert {(r.q, r.rank): r.c for r in got.collect()} == want


@pytest.mark.parametrize("per_query", [True, False])
def test_queries_stay_in_spark(spark, monkeypatch, per_query):
    """More queries than a block: none reaches the driver, blocks change nothing."""
    rnd = random.Random(12)
    words = [f"term{i}" for i in range(30)]
    text = lambda: " ".join(rnd.choice(words) for _ in range(8))
    corpus = spark.createDataFrame([(2 ** 60 + i, text()) for i in range(90)], "d long, text string").repartition(3)
    asked = spark.createDataFrame([(2 ** 61 + i, text()) for i in range(700)], "q long, text string").repartition(3)
    run = sim.similar_per_query if per_query else sim.similar_docs
    want = sorted(map(str, run(asked, corpus, "q", "text", "d", "text", max_terms=20)
                      .selectExpr("* except (similarity)", "round(similarity, 9)").collect()))
    rows, plain = [], type(asked).toPandas
    monkeypatch.setattr(type(asked), "toPandas", lambda self: rows.append(plain(self)) or rows[-1])
    monkeypatch.setattr(sim, "DOC_BLOCK", 8, raising=False)
    got = run(asked, corpus, "q", "text", "d", "text", max_terms=20).selectExpr("* except (similarity)", "round(similarity, 9)")
    assert max(map(len, rows)) <= 20
    assert sorted(map(str, got.collect())) == want and len(want) == (2100 if per_query else 3)


def test_best_of_any_moves_a_document_once(spark, monkeypatch):
    import random
    rnd, held = random.Random(3), {}
    words = [f"word{i}" for i in range(80)]
    rows = [(i, " ".join(rnd.sample(words, 25))) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, text string")
    asked = spark.createDataFrame([(i, " ".join(rnd.sample(words, 25))) for i in range(30)], "q long, text string")
    real = sim.written

    def spy(df, name):
        out = real(df, name)
        held[name] = out.count()
        return out
    monkeypatch.setattr(sim, "written", spy)
    monkeypatch.setattr(sim, "ANY_BLOCK", 50, raising=False)
    got = [(r.id, round(r.similarity, 9)) for r in sim.similar_docs(asked, docs, "q", "text", "id", "text").orderBy("rank").collect()]
    best = sim.best_matches(asked, docs, "q", "text", "id", "text", len(rows)).groupBy("id").max("similarity").collect()
    assert got == sorted(((r[0], round(r[1], 9)) for r in best), key=lambda r: (-r[1], r[0]))[:3]
    assert max(n for name, n in held.items() if name != "similar-champions") <= len(rows)
