"""Source mix and line frequency: plans without Python, edge cases, brute force."""
import random
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidings.llm import langid, linefreq, mixing
from tidings.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, shard int")


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(k in plan for k in ("Python", "Pandas", "Arrow"))


def test_targets_water_filling(spark):
    rnd = random.Random(4)
    for _ in range(6):
        sizes = [(f"s{i}", 1, rnd.choice([0, 1, 5, 100, 3000])) for i in range(rnd.randint(1, 9))] + [(None, 2, 40)]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, rows long, source_size long")).collect()}
        order = sorted(s for s, *_ in sizes if s is not None) + [None]
        size = {s: z for s, _, z in sizes}
        weight = {s: i % 3 + 1 for i, s in enumerate(order)}
        total, target, free = sum(size.values()), {}, set(order)
        while True:  # reshare the excess until no source is above
            left = total - sum(target.values())
            w = sum(weight[s] for s in free)
            above = {s for s in free if left * weight[s] / w > 3 * size[s]}
            if not above:
                target |= {s: left * weight[s] / w for s in free}
                break
            target |= {s: 3 * size[s] for s in above}
            free -= above
        assert all(abs(got[s] - target[s]) < 1e-6 for s in order)


def test_quotas_are_highest_quotients(spark):
    rnd = random.Random(8)
    want = [(k, i, rnd.randint(0, 40) * rnd.randint(0, 40) * 16) for k in range(40) for i in range(rnd.randint(1, 9))]
    got = {(r.shard, r.source_no): r.quota for r in mixing.quotas(
        spark.createDataFrame(want, "shard long, source_no int, want long"), 32).collect()}
    for k in range(40):
        group = [(i, w) for s, i, w in want if s == k]
        seats = int(sum(w for _, w in group) / (16 * 32) + 0.5)
        quotients = sorted(((-w / (2 * n + 1), i) for i, w in group if w for n in range(seats)))[:seats]
        brute = Counter(i for _, i in quotients)
        assert {i: got[k, i] for i, _ in group} == {i: brute[i] for i, _ in group}, k


def test_mix_edges(spark):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randint(0, 80), "hot" if i % 3 else f"s{i % 7}", "x", 1) for i in range(1500)]
    rows += [(5, None, None, "x", 1), (5, None, None, "x", 1), (None, "a b c", "s1", "x", 1), (6, "z " * 9000, "s2", "x", 1)]
    df = docs(spark, rows).repartition(6)
    m = mixing.mix(df, rows_per_shard=100)
    assert python_free(m)
    got = m.collect()
    assert len(got) == len(rows)
    assert sorted(str((r.doc_id, r["size"])) for r in got) == sorted(str((i, len((t or "").split()))) for i, t, *_ in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    per = Counter()
    for r in got:
        per[r.target, r.source_size] += r.taken
    for (target, _), taken in per.items():
        assert abs(taken - target) <= 0.03 * target + 64
    again = mixing.mix(df.repartition(3), rows_per_shard=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).count() == 0
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix(docs(spark, [(1, None, "a", "", 0), (2, "", None, "", 0)])).collect())


def test_mixed_documents_keep_columns_and_size(spark):
    rows = [(i, "w " * (20 + i % 30), f"s{i % 4}", "x", i) for i in range(400)]
    df = docs(spark, rows)
    m = mixing.mixed_documents(df)
    assert m.columns == df.columns
    words = m.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert abs(words - sum(20 + i % 30 for i in range(400))) < 0.02 * words
    assert m.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def brute_lines(rows, ratio, min_pages, min_count):
    pages = Counter(h for _, h, _ in rows)
    seen = Counter((h, x) for _, h, t in rows for x in {y.strip(" ") for y in (t or "").split("\n")} if x)
    bad = {(h, x) for (h, x), n in seen.items() if n >= min_count and pages[h] >= min_pages and n / pages[h] > ratio}
    out = []
    for i, h, t in rows:
        kept = None if t is None else [x for x in t.split("\n") if (h, x.strip(" ")) not in bad]
        out.append((i, h, None if kept is None else "\n".join(kept), 0 if t is None else t.count("\n") + 1,
                    0 if t is None else t.count("\n") + 1 - len(kept)))
    return out


def test_line_frequency_against_brute_force(spark):
    rnd = random.Random(6)
    lines = ["menu", " menu ", "footer line", "", "body a", "body b", "x" * 5000]
    rows = [(i, rnd.choice(["hot", "hot", "h2", None]), "\n".join(rnd.choice(lines + [f"own {i}", f"t{i}"]) for _ in range(rnd.randint(1, 7))))
            for i in range(300)]
    rows += [(1, "hot", None), (2, None, ""), (2, None, ""), (None, "solo", "menu\nmenu")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, source string, text string, n_lines int").repartition(5)
    out = linefreq.drop_boilerplate(df, ratio=0.4, min_pages=10, min_count=5)
    assert python_free(out)
    got = sorted(str((r.doc_id, r.source, r.text, r.n_lines, r.n_dropped)) for r in out.collect())
    assert got == sorted(map(str, brute_lines(rows, 0.4, 10, 5)))
    assert any("'footer" in x for x in got) or any(r[4] for r in brute_lines(rows, 0.4, 10, 5))
    assert linefreq.drop_boilerplate(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want, got = con.sql(ORACLE[name]).df(), QUERIES[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    key = "vec_id" if "vec_id" in cols else "doc_id"
    want, got = (x[cols].sort_values([key]).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(want, got, check_dtype=False)


def test_clashing_names_of_columns(spark):
    """Working columns never replace or meet the input's own."""
    rows = [(k, f"menu\nown line {k}", "h", 1, 2, 3, 4) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _host int, HOST int, _flagged int, kept int")
    out = linefreq.drop_boilerplate(df).collect()
    assert {(r.text, r.n_dropped, r["_host"], r["HOST"], r["_flagged"], r["kept"]) for r in out} == \
        {(f"own line {k}", 1, 1, 2, 3, 4) for k in range(30)}
    train = spark.createDataFrame([("the cat sat on the mat and the dog", "en"), ("der hund und die katze auf der matte", "de")], "text string, lang string")
    prototypes = langid.train(train)
    odd = spark.createDataFrame([(1, "the dog and the cat", "a", 1, "b", 2.0, 3)],
                                "doc_id long, text string, _found string, judged int, lang_pred string, score double, Size int")
    assert [tuple(r) for r in langid.accepted(odd, prototypes).collect()] == [(1, "the dog and the cat", "a", 1, "b", 2.0, 3)]
    one = langid.identify(odd, prototypes).first()
    assert (one.lang_pred, one["_found"], one.judged, one["Size"]) == ("en", "a", 1, 3)
