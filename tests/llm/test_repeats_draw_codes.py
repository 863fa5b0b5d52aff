"""Column-wise repeat removal, importance draw and metric-tree codebooks
against brute force, SQL and edge cases."""
import os
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidings.llm import codebooks, resample, suffixes
from tidings.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_column_bwt", "op12_importance_draw", "op13_metric_codebooks"])
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    for t in ("documents", "benchmark", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    columns = ", ".join(sorted(got.columns))
    want = duckdb.sql(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=key) == sorted(want, key=key)
    assert len(want) >= 200


# ---------------------------------------------------------------- repeats

def _brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(d, cover) if not c)
        n = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out.append((len(d), sum(cover), n, hashlib.sha256(kept).hexdigest(), kept))
    return out


def _texts(rnd):
    shared = "".join(rnd.choice("abcdé ") for _ in range(90))
    texts = [None, "", "kurz", "z" * 300, shared, shared]
    for _ in range(40):
        body = "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(0, 120)))
        a, b = sorted(rnd.sample(range(len(shared) + 1), 2))
        texts.append(body + shared[a:b] + rnd.choice(["", body[:50], "xyz"]))
    return texts


@pytest.mark.parametrize("group", [2000, 3])
def test_repeats_by_brute_force(spark, group):
    texts = _texts(random.Random(5))
    rows = [(i if i % 7 else None, t, "kept", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t string, found long")
    got = {r.found: r for r in suffixes.drop_repeats(docs, length=24, group=group).collect()}
    for i, (n, removed, spans, sha, kept) in enumerate(_brute(texts, 24)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == (n, removed, spans, sha, kept)
        assert (r.doc_id, r.text, r.t) == (rows[i][0], texts[i], "kept") and len(r.removed) == spans


def test_repeats_of_a_hot_passage_with_many_contexts(spark):
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcdefghij") for _ in range(300))
    texts = ["".join(rnd.choice("klmnop") for _ in range(120)) + passage + str(i) for i in range(60)] + [passage[40:290]]
    got = suffixes.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), group=8)
    want = _brute(texts, 200)
    for r in got.collect():
        assert (r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id][1:4]


def test_repeats_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_bytes long")
    out = suffixes.drop_repeats(docs)
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "text"]


def test_slices_cut_runs_not_strings(monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 50)
    text = bytes(random.Random(1).choices(b"abc", k=1000))
    places = [s for _, at, first, last in suffixes.scan(text, 40, 20) for f, t in zip(first, last) for s in range(f, t + 1)]
    assert places == list(range(1000 - 40 + 1))


# ---------------------------------------------------------------- draw

def _draw(docs, target, percent=25, least=20):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [" ".join(p) for p in zip(w, w[1:])]]
    d, t = [features(x) for _, x in docs], [features(x) for x in target]
    s, b = Counter(x for _, f in d for x in f), Counter(x for _, f in t for x in f)
    big_s, big_t = sum(s.values()), sum(b.values())
    gain = lambda x: math.floor(1000 * math.log((b[x] + 1) * (big_s + 10000) / ((s[x] + 1) * (big_t + 10000))))
    rows = []
    for (i, _), (n, f) in zip(docs, d):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    return rows, able[:percent * len(able) // 100]


@pytest.mark.parametrize("accuracy", [1000, 4])
def test_draw_by_brute_force(spark, accuracy):
    rnd = random.Random(2)
    vocabulary = ["Ärger", "apfel", "X1", "straße", "b", "Ω9", "東京", "the"]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 60))) + "!-") for i in range(120)] + [(200, None), (201, "")]
    target = [" ".join(rnd.choices(vocabulary[:3], k=30)), None]
    got = resample.resample(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string"),
                            spark.createDataFrame([(t,) for t in target], "text string"), accuracy=accuracy)
    rows, drawn = _draw(docs, target)
    rank = {r[0]: k + 1 for k, r in enumerate(drawn)}
    assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect())) == \
        sorted((r[0], r[2], r[3], r[4], rank.get(r[0])) for r in rows)


def test_repeated_rows_are_ranked_one_by_one(spark):
    text = " ".join(["wort"] * 25)
    docs = spark.createDataFrame([(5, text)] * 40 + [(None, text)] * 20, "doc_id long, text string")
    got = resample.resample(docs, docs.limit(0)).collect()
    assert len(got) == 60 and sorted(r.rank for r in got if r.rank) == list(range(1, 16))


def test_nothing_to_draw(spark):
    docs = spark.createDataFrame([(1, "zu kurz")], "doc_id long, text string")
    assert [r["rank"] for r in resample.resample(docs, docs).collect()] == [None]
    assert resample.resample(docs.limit(0), docs).count() == 0


def test_draw_needs_no_python(spark):
    docs = spark.createDataFrame([(1, "zu kurz")], "doc_id long, text string")
    plan = resample.features(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- codebooks

def _fit(points, parts, entries, rounds):
    """(codes, errors, books) by comparing every part with every entry."""
    x = np.stack(np.split(points, parts, axis=1))
    books = x[:, :entries].copy()

    def assign():
        d = ((x[:, :, None, :] - books[:, None, :, :]) ** 2).sum(3)
        return d.argmin(2), d.min(2)
    for _ in range(rounds):
        code, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[p][code[p] == e]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code, error = assign()
    return code, error.sum(0), books


def test_trees_find_the_nearest_entry():
    rnd = np.random.default_rng(3)
    for n, spread in ((1, 5), (30, 2), (700, 6), (900, 400)):
        points = rnd.integers(-spread, spread + 1, (n, 3))
        points[n // 2:] = points[0]  # half of them are equal
        tree = codebooks.build(points)
        assert sorted(tree["order"].tolist()) == list(range(n)) and tree["count"][tree["root"]] == n
        entries = rnd.integers(-spread, spread + 1, (40, 3))
        entries[7] = entries[3]
        book = codebooks._Book(entries)
        code, error = codebooks.nearest(tree, book)
        d = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (code == d.argmin(1)).all() and (error == d.min(1)).all()
        sums, counts = np.zeros_like(entries), np.zeros(40, np.int64)
        codebooks.tallies(tree, book, sums, counts)
        assert (counts == np.bincount(code, minlength=40)).all()
        assert all((sums[e] == points[code == e].sum(0)).all() for e in range(40))


def test_far_clusters_are_owned_whole():
    rnd = np.random.default_rng(4)
    points = np.concatenate([rnd.integers(0, 9, (300, 4)) + 1000 * k for k in range(8)])
    entries = np.array([[1000 * k + 4] * 4 for k in range(8)])
    compared = []
    codebooks.walk(codebooks.build(points), codebooks._Book(entries), lambda *_: None, lambda rows, *_: compared.append(len(rows)))
    assert sum(compared) == 0  # lists shrink to one entry before any leaf


def test_codes_by_brute_force(spark):
    rnd = np.random.default_rng(5)
    real = [(int(i), [float(x) for x in v], None if i % 5 == 0 else int(i % 3))
            for i, v in zip(rnd.permutation(400), rnd.normal(size=(400, 8)))]
    real += [(500, real[0][1], 1)] * 30
    bad = [(900, None, 1), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] + [0.0] * 7, 1), (903, [float("inf")] + [0.0] * 7, 1)]
    rows = [(*r, "x") for r in real + bad]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string")
    got = codebooks.compress(vectors, entries=16, chunk=100).collect()
    real.sort(key=lambda r: r[0])
    code, error, books = _fit(np.floor(1024 * np.array([r[1] for r in real])).astype(np.int64), 4, 16, 4)
    names = ["".join(f"{c:02x}" for c in cs) for cs in code.T.tolist()]
    by_label = Counter()
    for r, e in zip(real, error.tolist()):
        by_label[r[2]] += e
    want = sorted((r[0], c, e, by_label[r[2]]) for r, c, e in zip(real, names, error.tolist()))
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_odd_vectors_have_codes(spark):
    rows = [(1, [], 1), (2, [1.0], 1), (3, [1e300] * 5, None), (4, [-1e300] * 5, 2), (None, [0.5] * 6, 1)]
    got = codebooks.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == 5 and all(r.error == 0 and len(r.code) == 8 for r in got)  # every vector is an entry
    none = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<double>, label int")
    assert codebooks.compress(none).count() == 0 and codebooks.compress(none.limit(0)).count() == 0


def test_sorted_pairs_of_a_column_take_four_bytes():
    """Symbol and place, up to the highest symbol, before and after columns were inserted."""
    bwt = np.array([suffixes.END, 0, suffixes.MARK, 0, 97, suffixes.END], np.uint8)
    keys = suffixes._keys(bwt)
    assert keys.dtype.itemsize == 4
    assert [(int(k) >> 24, int(k) & 0xFFFFFF) for k in keys] == sorted((int(b), i) for i, b in enumerate(bwt))
    docs = [b"ab\xfeab", b"b\xfea", b"\xf4\xfe", b"ab\xfeab"]
    c = suffixes.insert_columns(suffixes.insert_columns(suffixes.new_collection(docs), 3), 3)
    whole = sorted((d[k:] + bytes([0]), i, d[k - 1] if k else suffixes.END) for i, d in enumerate(docs) for k in range(len(d) + 1))
    assert sorted(c["bwt"].tolist()) == sorted(x for *_, x in whole) and (c["at"] == -1).all()


def test_a_round_sorts_single_bytes_only(monkeypatch):
    """Places rise from round to round, so only the symbols ahead are sorted."""
    docs = [b"ab\xfeab", b"b\xfea", b"\xf4\xfe", b"ab\xfeab", b"abab\xfeab"]
    sorts = {}
    for rounds in (2, 4):
        seen = []
        with monkeypatch.context() as m:
            m.setattr(np, "argsort", lambda x, *a, f=np.argsort, **b: seen.append(np.asarray(x).itemsize) or f(x, *a, **b))
            c = suffixes.insert_columns(suffixes.new_collection(docs), rounds)
        sorts[rounds] = seen
    assert sum(x > 1 for x in sorts[2]) == sum(x > 1 for x in sorts[4])
    c = suffixes.insert_columns(c, 9)
    whole = sorted((d[k:] + bytes([0]), i) for i, d in enumerate(docs) for k in range(len(d) + 1))
    common = [len(os.path.commonprefix([a[:-1], b[:-1]])) for (a, _), (b, _) in zip(whole, whole[1:])]
    assert sorted(c["lcp"].tolist()) == sorted([0, *common])


def test_minima_on_both_sides():
    rnd = np.random.default_rng(3)
    lcp = rnd.integers(0, 99, 50).astype(np.uint8)
    p = np.arange(48, 0, -3)
    before, after = p - rnd.integers(1, p + 1), p + rnd.integers(1, 50 - p)
    up, down = suffixes._minima(lcp, before, p, after)
    assert up.tolist() == [lcp[b + 1:x + 1].min() for b, x in zip(before, p)]
    assert down.tolist() == [lcp[x + 1:a + 1].min() for x, a in zip(p, after)]
