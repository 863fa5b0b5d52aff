"""Near-duplicate operators against brute force on planted groups."""
import os
import random
import re

import numpy as np
import pytest

from tidings.llm import graph, multiindex, shingles, weightedhash
from tidings.session import ensure_checkpoint_dir


def union(pairs, ids):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    links += [(rnd.randint(2000, 2100), rnd.randint(2000, 2100)) for _ in range(70)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    want = union(links, {x for ab in links for x in ab})
    assert got == {i: c for i, c in want.items() if any(i in ab for ab in links if ab[0] != ab[1])}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def word_set(text, size=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_shingles_against_loop():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["a", "B", "c-d", "é_x", "漢字", "9"]) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    texts += ["", "...", "one", "a b c d e a b c d e a b c d e", "ß Σ", "x" * 5000]
    text, h, count = shingles.shingles(texts)
    sets = [word_set(t) for t in texts]
    assert [int((text == i).sum()) for i in range(len(texts))] == [len(s) for s in sets]
    same = {}
    for i, s in enumerate(sets):
        for j, z in enumerate(sets[:i]):
            if s == z and s:
                assert set(h[text == i]) == set(h[text == j])
    assert count.max() > 1 and len(np.unique(h)) == len(set().union(*sets))
    assert same == {}


def test_samples_agree_with_similarity():
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 999999)}" for _ in range(400)]
    agree, real = [], []
    for _ in range(40):
        other = list(base)
        for i in rnd.sample(range(400), rnd.randint(0, 25)):
            other[i] = f"z{rnd.randint(0, 999999)}"
        text, h, count = shingles.shingles([" ".join(base), " ".join(other)])
        w = weightedhash.weights(h, count, np.full(64, 0.6))
        s = weightedhash.samples(text, h, w, 2)
        k = int((text == 0).sum())
        agree.append((s[0] == s[1]).mean())
        real.append(weightedhash.weighted_jaccard((h[:k], w[:k]), (h[k:], w[k:])))
    assert abs(np.mean(agree) - np.mean(real)) < 0.03 and np.corrcoef(agree, real)[0, 1] > 0.9


def near_texts(seed=4):
    rnd = random.Random(seed)
    fresh = lambda n: [f"w{rnd.randint(0, 10 ** 7)}" for _ in range(n)]
    passage = fresh(30)
    texts = [" ".join(fresh(60) + passage) for _ in range(60)]  # share a passage, not near
    for size in (2, 5, 120):
        base = fresh(300)
        for _ in range(size):
            copy = list(base)
            for i in rnd.sample(range(300), rnd.randint(0, 5)):
                copy[i] = fresh(1)[0]
            texts.append(" ".join(copy))
    chain = fresh(300)
    for _ in range(8):  # each near the one before only
        for i in rnd.sample(range(300), 6):
            chain[i] = fresh(1)[0]
        texts.append(" ".join(chain))
    return texts + [texts[3]] * 40 + ["Short one", "short, one!", "other"]


def test_near_documents_against_brute_force(spark):
    texts = near_texts()
    rows = [(i * 2, t, "x") for i, t in enumerate(texts)] + [(9001, None, "x"), (9003, None, "x"), (9005, "", "x"), (9007, "", "x"), (9009, "...", "x"), (None, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(5)
    got = {r.doc_id: r for r in weightedhash.near_documents(df).collect()}
    usable = [(i, t) for i, t, _ in rows if i is not None and t is not None]
    sets = {i: word_set(t) for i, t in usable}
    idf = weightedhash.shingle_frequencies(df)

    def weighted(t):
        _, h, c = shingles.shingles([t])
        return h, weightedhash.weights(h, c, idf)
    w = {i: weighted(t) for i, t in usable}
    pairs = [(a, b) for k, (a, x) in enumerate(usable) for b, y in usable[:k]
             if x == y or (sets[a] & sets[b] and weightedhash.weighted_jaccard(w[a], w[b]) >= 0.8)]
    want = union(pairs, [i for i, _ in usable])
    assert {i: got[i].component_id for i in want} == want
    assert got[9001].component_id == 9001 and got[9003].kept and got[9007].component_id == 9005 and got[9009].component_id == 9009
    assert got[None].component_id is None and got[None].kept
    assert got[6].n_copies == 41
    left = weightedhash.keep_one(df)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted([str(i) for i, c in want.items() if i == c] + ["9001", "9003", "None"])
    assert weightedhash.near_documents(df.limit(0)).count() == 0


def test_repeated_ids_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "q"), (3, "r")], "doc_id long, text string")
    assert sorted(r.doc_id for r in weightedhash.keep_one(df).collect()) == [1, 3]


@pytest.mark.parametrize("block", [128, 8])
def test_links_across_blocks_join_what_is_similar(spark, monkeypatch, block):
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{i}"] + base[k:]) for i, k in enumerate(rnd.choice([3, 20, 21, 40, 57]) for _ in range(50))]
    idf = np.full(64, 0.5)
    text, h, count = shingles.shingles(texts)
    w = weightedhash.weights(h, count, idf)
    sample = weightedhash.samples(text, h, w, len(texts))
    sets = [(h[text == i], w[text == i]) for i in range(len(texts))]
    bands = [[b + 1 for b in range(4) if (i >> b) & 1 or i % 5 == 0] for i in range(len(texts))]
    rows = [(b, i, i, sample[i].tobytes(), bands[i], texts[i]) for i in range(len(texts)) for b in bands[i]]
    monkeypatch.setattr(weightedhash, "BLOCK", block)
    df = spark.createDataFrame(rows, "band long, id long, component long, sample binary, bands array<long>, text string").repartition(5)
    got = [(r.a, r.b) for r in weightedhash.links_across(df, idf).collect()]
    real = [(i, j) for j in range(len(texts)) for i in range(j) if set(bands[i]) & set(bands[j])
            and (sample[i] == sample[j]).mean() >= 0.5 and weightedhash.weighted_jaccard(sets[i], sets[j]) >= 0.8]
    assert {tuple(sorted(p)) for p in got} <= set(real) and real
    assert union(got, range(len(texts))) == union(real, range(len(texts)))


def brute_vectors(rows):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = [v / np.linalg.norm(v) for _, v in good]
    ids = [i for i, _ in good]
    pairs = [(ids[a], ids[b]) for a in range(len(ids)) for b in range(a) if len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.9]
    links = {i: 0 for i, _ in rows if i is not None}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return links, union(pairs, links)


@pytest.mark.parametrize("block", [512, 16])
def test_near_vectors_against_brute_force(spark, monkeypatch, block):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(150)]
    for size, noise in ((30, 0.05), (60, 0.12), (5, 0.0)):
        base = rng.normal(size=16)
        rows += [(len(rows) + k, (base + noise * rng.normal(size=16)).tolist()) for k in range(size)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 16), (n + 2, [1.0, None] + [0.0] * 14), (n + 3, [float("nan")] * 16), (n + 4, [float("inf")] * 16),
             (n + 5, []), (n + 6, [3.0]), (n + 7, [0.5]), (n + 8, [2 * x for x in rows[0][1]]), (n + 9, [1.0, 0.0, 0.0]), (None, rows[3][1])]
    monkeypatch.setattr(multiindex, "BLOCK", block)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int").repartition(4)
    got = {r.vec_id: r for r in multiindex.near_vectors(df).collect()}
    links, parts = brute_vectors(rows)
    found, real = sum(got[i].n_links for i in links), sum(links.values())
    assert 0.97 * real <= found <= real and all(got[i].n_links <= links[i] for i in links)
    assert {i: got[i].component_id for i in links} == parts
    assert all(got[i].kept == (got[i].component_id == i) for i in links)
    assert got[None].n_links == 0
    assert multiindex.near_vectors(df.limit(0)).count() == 0


def test_grid_order_is_by_distance():
    rng = np.random.default_rng(1)
    grid = multiindex.Grid(rng.normal(size=(7, 4)), rng.normal(size=(9, 3)))
    x = rng.normal(size=(20, 7))
    left, right = grid.halves(x)
    for q, cells in enumerate(grid.nearest(x, 20)):
        total = (left[q][:, None] + right[q][None, :]).reshape(-1)
        assert np.allclose(total[cells], np.sort(total)[:20])


def test_reach_holds_the_nearest_cells_and_few_more():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = multiindex.Grid(x[:60, :16], x[60:130, 16:])
    left, right = grid.halves(x)
    for cells in (1, 7, 300, 4199, 4200):
        reach = grid.reach(left, right, cells)
        within = np.array([(left[q][:, None] + right[q][None, :] <= reach[q]).sum() for q in range(len(x))])
        assert (within >= cells).all() and within.mean() <= 1.2 * cells + 2


def index_entries(rng, grid, visit, kind):
    """Near groups with a few cosines on either side of 0.9, as rows of the index hold them."""
    base = np.repeat(rng.normal(size=(40, 16)), 10, axis=0)
    raw = (base + 0.25 * rng.normal(size=base.shape)).astype(kind)
    x, largest, norm = multiindex.unit(raw)
    e = {"v": raw, "largest": largest, "norm": norm, "rep": np.arange(len(raw)) * 3, "n": rng.integers(1, 4, len(raw))}
    left, right = grid.halves(multiindex._single(e))
    e |= {"cell": left.argmin(1) * right.shape[1] + right.argmin(1), "reach": grid.reach(left, right, visit), "near": right.min(1)}
    visits = left[:, e["cell"] // right.shape[1]] + right[:, e["cell"] % right.shape[1]] <= e["reach"][:, None]
    return e, (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool), visits


@pytest.mark.parametrize("kind, visit, block", [("<f4", 2, 512), ("<f8", 6, 2), ("<f4", 90, 3)])
def test_links_found_from_one_side_count_for_both(monkeypatch, kind, visit, block):
    rng = np.random.default_rng(4)
    codes = rng.normal(size=(19, 8))
    codes /= 1.5 * np.linalg.norm(codes, axis=1)[:, None]
    grid = multiindex.Grid(codes[:10], codes[10:])
    e, near, visits = index_entries(rng, grid, visit, kind)
    monkeypatch.setattr(multiindex, "VISITS", 500)
    monkeypatch.setattr(multiindex, "PRODUCT", 64)
    monkeypatch.setattr(multiindex, "BLOCK", block)
    order = e["cell"].argsort(kind="stable")
    n, links = np.zeros(len(order), int), []
    for at in np.array_split(order, 3):  # parts; a cell may be in two
        part = multiindex.Part({k: v[at] for k, v in e.items()}, grid)
        for some in np.array_split(order[::-1], 2):
            counts, edges = part.meet({k: v[some] for k, v in e.items()}, 0.9)
            np.add.at(n, counts["a"].to_numpy() // 3, counts["n"].to_numpy())
            links += list(zip(edges["a"], edges["b"], strict=True))
    found = near & (visits | visits.T)
    assert (found & ~(visits & visits.T)).any() or visit == 90
    assert (n == found @ e["n"]).all()
    assert union(links, e["rep"]) == union([(a * 3, b * 3) for a, b in np.argwhere(found)], e["rep"])


def test_disk_follows_the_table_not_the_visits(spark):
    """A query visits a third of the cells; neither visits nor vectors per visit are written."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)

    def disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
        return (sum(files.apply(i).length() for i in range(files.size()))
                + sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(tables) for f in names))
    before = disk()
    assert multiindex.near_vectors(df).count() == len(x)
    assert disk() - before < 8 * x.size * 4  # the shuffles of the input and of the checks of this test included


def test_rare_links_are_found(spark):
    """No calibration query has a link; the planted ones beside them are found."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u = rng.normal(size=(100, 32))
    u -= (u * x[:100]).sum(1)[:, None] * x[:100]
    c = rng.uniform(0.9005, 0.95, 100)[:, None]
    y = c * x[:100] + (1 - c * c) ** 0.5 * u / np.linalg.norm(u, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r.vec_id: r.component_id for r in multiindex.near_vectors(df).collect()}
    assert np.mean([got[6000 + i] == got[i] for i in range(100)]) >= 0.99

    reps = spark.createDataFrame([(i, v, 1) for i, v in rows[:2000]], "rep long, v array<double>, n long")
    grid = multiindex.fit(reps, 2000)
    assert not (np.triu(x[:2000] @ x[:2000].T, 1) >= 0.9).any()
    visit = multiindex.calibrate(reps, grid, 1.0)
    near = np.minimum(grid.depths(x[:100], y), grid.depths(y, x[:100]))
    assert (near <= visit).mean() >= 0.99 > (near <= 1).mean()


def test_frequencies_are_exact_and_scale_with_the_corpus(spark, monkeypatch):
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [" ".join(f"w{rnd.randint(0, 10 ** 7)}" for _ in range(200)) + (" " + passage if i % 4 == 0 else "") for i in range(1000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "doc_id long, text string").repartition(4)
    _, h, _ = shingles.shingles(texts)
    one, n = np.unique(h, return_counts=True)
    exact = np.log(1001 / (1 + n)) / np.log(1001)
    assert len(one) > 2 * 65536 and n.max() == 250
    assert np.allclose(weightedhash.shingle_frequencies(df).of(one), exact, atol=1e-6)
    monkeypatch.setattr(weightedhash, "REFERENCE", 100)  # a corpus of ten times the reference
    scaled = np.log(101 / (1 + np.maximum(1, n / 10))) / np.log(101)
    found = weightedhash.shingle_frequencies(df)
    assert np.allclose(found.of(one), scaled, atol=1e-6) and len(found.h) == (n > 10).sum()


def test_every_row_of_repeated_ids_stays(spark):
    """Rows of one id are vectors of their own; very large and small components link."""
    rows = [(7, [1.0, 0.0, 1.0]), (7, [1.0, 0.01, 1.0]), (8, None), (8, [1e200, 0.0, 1e200]), (9, [1e-200, 0.0, 1e-200]),
            (9, [0.0, 1.0, 0.0]), (5, [0.0, 1.0, 0.1]), (None, [1.0, 0.0, 1.0]), (8, [0.0, 0.0, 0.0]), (6, [5e-324, 0.0, 5e-324])]
    got = multiindex.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == sorted([
        (False, 7, 4, 6), (False, 7, 4, 6), (False, 8, 4, 6), (False, 9, 4, 6), (False, 6, 4, 6),
        (False, 8, 0, 8), (False, 8, 0, 8), (False, 9, 1, 5), (False, 5, 1, 5), (True, 0, 0, 0)])
    assert {(r.vec_id, r.kept) for r in got if r.n_links} == {(7, False), (8, False), (9, False), (6, True), (5, True)}
