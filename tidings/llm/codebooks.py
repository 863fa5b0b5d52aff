"""Vector compression by one codebook per vector part, fitted with metric trees.

Vectors of whole numbers are cut into consecutive parts; each part position
has a codebook, refined by rounds of exact nearest-entry assignment. Work is
dealt in chunks of vectors. A chunk holds one anchors hierarchy per part
position: about sqrt(n) anchors are placed (each the point farthest from the
anchor that owns it, taking over what is nearer to it), merged upwards two by
two into balls, and each anchor is split in the same way below, so the tree
grows from the middle out. Every ball caches the number and sum of its points.

A round walks the trees. A ball inherits its parent's list of candidate
entries and drops each that is farther than another one everywhere in the
ball; a ball with one candidate left is wholly owned and adds its cached sum
and number to that entry; the points of a leaf are compared with what is left.
All sums are whole numbers, so the result equals comparing every point with
every entry. Trees are written once, to the shared checkpoint folder, and read
by every round; a task returns one row per codebook entry and the driver holds
the codebooks alone (parts x entries x part length numbers).

Vectors that are null or hold null or non-finite components are dropped.
Vectors of different lengths, empty ones included, are filled up with zeros to
the longest length, rounded up to a multiple of the parts. Components beyond
the limit at which squared distances fit 64 bits (2^27 for 64 dimensions) are
held there. Repeated rows count one by one; ids may repeat or be null (last in
order). With fewer vectors than entries the codebook is as small as their
number; an empty table gives an empty result. Label errors beyond 64 bits are
null. Only the named columns are read, so extra columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024.0
CHUNK = 4096  # vectors whose trees are built in one piece
LEAF = 24  # points that are compared one by one


# ---------------------------------------------------------------- trees

def _sq(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = points - centre
    return np.einsum("ij,ij->i", d, d)


class _Tree:
    """Balls as parallel lists; a leaf is a range of ``order``."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, []
        self.centre, self.radius, self.sums, self.count, self.kids, self.range = [], [], [], [], [], []

    def add(self, centre, radius, sums, count, kids, span) -> int:
        for held, x in zip((self.centre, self.radius, self.sums, self.count, self.kids, self.range),
                           (centre, radius, sums, count, kids, span)):
            held.append(x)
        return len(self.count) - 1

    def leaf(self, rows: np.ndarray) -> int:
        pts = self.points[rows]
        sums = pts.sum(0)
        centre = sums / len(rows)
        start = len(self.order)
        self.order.extend(rows.tolist())
        return self.add(centre, float(np.sqrt(_sq(pts, centre).max())), sums, len(rows), (-1, -1), (start, len(self.order)))

    def merge(self, a: int, b: int) -> int:
        """The ball around two balls whose points are neighbours in ``order``
        or not: a merged ball is described by its children alone."""
        n = self.count[a] + self.count[b]
        sums = self.sums[a] + self.sums[b]
        centre = sums / n
        radius = max(float(np.sqrt(((centre - self.centre[k]) ** 2).sum())) + self.radius[k] for k in (a, b))
        return self.add(centre, radius, sums, n, (a, b), (0, 0))


def anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Rows owned by each of about ``wanted`` anchors. A new anchor is the
    point farthest from its owner; an owner's points nearer to their owner
    than half way to the new anchor cannot change hands and are not compared."""
    rows, dist = [np.arange(len(points))], [np.sqrt(_sq(points, points[0]))]
    pivots = [points[0]]
    while len(rows) < wanted:
        far = [d.max() for d in dist]
        widest = int(np.argmax(far))
        if far[widest] == 0:
            break
        pivot = points[rows[widest][int(np.argmax(dist[widest]))]]
        got_rows, got_dist = [], []
        for k in range(len(rows)):
            gap = np.sqrt(((pivots[k] - pivot) ** 2).sum())
            near = dist[k] >= gap / 2
            if not near.any():
                continue
            at = np.flatnonzero(near)
            d = np.sqrt(_sq(points[rows[k][at]], pivot))
            lost = d < dist[k][at]
            if lost.any():
                got_rows.append(rows[k][at[lost]])
                got_dist.append(d[lost])
                keep = np.ones(len(rows[k]), bool)
                keep[at[lost]] = False
                rows[k], dist[k] = rows[k][keep], dist[k][keep]
        rows.append(np.concatenate(got_rows))
        dist.append(np.concatenate(got_dist))
        pivots.append(pivot)
    return [r for r in rows if len(r)]


def _grow(tree: _Tree, rows: np.ndarray) -> int:
    if len(rows) <= LEAF:
        return tree.leaf(rows)
    points = tree.points[rows].astype(np.float64)
    groups = anchors(points, max(2, int(np.sqrt(len(rows)))))
    if len(groups) == 1:  # equal points
        return tree.leaf(rows)
    balls = [_grow(tree, rows[g]) for g in groups]
    # merge upwards: always the two balls that fit into the smallest one
    centres = np.array([tree.centre[b] for b in balls])
    radii = np.array([tree.radius[b] for b in balls])
    counts = np.array([tree.count[b] for b in balls], np.float64)
    live = np.ones(len(balls), bool)

    def fits(i: int) -> np.ndarray:
        n = counts + counts[i]
        mid = (centres * counts[:, None] + centres[i] * counts[i]) / n[:, None]
        size = np.maximum(np.sqrt(((mid - centres) ** 2).sum(1)) + radii, np.sqrt(((mid - centres[i]) ** 2).sum(1)) + radii[i])
        size[~live] = np.inf
        size[i] = np.inf
        return size

    cost = np.array([fits(i) for i in range(len(balls))])
    for _ in range(len(balls) - 1):
        a, b = np.unravel_index(int(np.argmin(cost)), cost.shape)
        balls[a] = tree.merge(balls[a], balls[b])
        live[b] = False
        centres[a], radii[a], counts[a] = tree.centre[balls[a]], tree.radius[balls[a]], tree.count[balls[a]]
        cost[b, :], cost[:, b] = np.inf, np.inf
        cost[a, :] = fits(a)
        cost[:, a] = cost[a, :]
    return balls[int(np.flatnonzero(live)[0])]


def build(points: np.ndarray) -> dict:
    """The anchors hierarchy over whole-number points, as arrays."""
    tree = _Tree(points)
    root = _grow(tree, np.arange(len(points)))
    return {"root": root, "order": np.array(tree.order, np.int32), "points": points,
            "centre": np.array(tree.centre, np.float64), "radius": np.array(tree.radius, np.float64),
            "sums": np.array(tree.sums, np.int64), "count": np.array(tree.count, np.int64),
            "kids": np.array(tree.kids, np.int32), "range": np.array(tree.range, np.int32)}


class _Book:
    """A codebook ready for walks: distinct entries (of equal ones the lowest
    index alone can win) and their mutual distances."""

    def __init__(self, entries: np.ndarray):
        _, first = np.unique(entries, axis=0, return_index=True)
        self.index = np.sort(first)
        self.entries = entries[self.index]
        self.real = self.entries.astype(np.float64)
        gap = self.real[:, None, :] - self.real[None, :, :]
        self.gap = np.sqrt((gap * gap).sum(2))


def walk(tree: dict, book: _Book, owned, compared) -> None:
    """Calls ``owned(ball, entry)`` for balls that one entry owns wholly and
    ``compared(rows, entries, squared distances)`` for the points of leaves;
    entries are places in the book."""
    stack = [(tree["root"], np.arange(len(book.index)))]
    while stack:
        ball, some = stack.pop()
        if len(some) > 1:
            d = ((book.real[some] - tree["centre"][ball]) ** 2).sum(1)
            best = int(np.argmin(d))
            # an entry whose half space misses the ball is farther everywhere in it
            slack = 1e-9 * (d + d[best] + 1.0)
            some = some[d - d[best] <= 2 * tree["radius"][ball] * (1 + 1e-9) * book.gap[some[best], some] + slack]
        if len(some) == 1:
            owned(ball, int(some[0]))
            continue
        a, b = tree["kids"][ball]
        if a >= 0:
            stack += [(a, some), (b, some)]
            continue
        start, end = tree["range"][ball]
        rows = tree["order"][start:end]
        gap = tree["points"][rows][:, None, :] - book.entries[some][None, :, :]
        d = np.einsum("ijk,ijk->ij", gap, gap)
        best = d.argmin(1)  # the first of equal ones: places follow the index
        compared(rows, some[best], d[np.arange(len(rows)), best])


def _below(tree: dict, ball: int) -> np.ndarray:
    """Rows of all points in a ball."""
    out, stack = [], [ball]
    while stack:
        a, b = tree["kids"][(k := stack.pop())]
        if a >= 0:
            stack += [a, b]
        else:
            out.append(tree["order"][tree["range"][k][0]:tree["range"][k][1]])
    return np.concatenate(out)


def tallies(tree: dict, book: _Book, sums: np.ndarray, counts: np.ndarray) -> None:
    """Adds every point to its nearest entry's sum and number."""
    def owned(ball: int, entry: int) -> None:
        sums[book.index[entry]] += tree["sums"][ball]
        counts[book.index[entry]] += tree["count"][ball]

    def compared(rows: np.ndarray, entries: np.ndarray, _: np.ndarray) -> None:
        np.add.at(sums, book.index[entries], tree["points"][rows])
        np.add.at(counts, book.index[entries], 1)
    walk(tree, book, owned, compared)


def nearest(tree: dict, book: _Book) -> tuple[np.ndarray, np.ndarray]:
    """Each point's entry and squared distance, in the order of the points."""
    code, error = np.empty(len(tree["points"]), np.int64), np.empty(len(tree["points"]), np.int64)

    def owned(ball: int, entry: int) -> None:
        rows = _below(tree, ball)
        gap = tree["points"][rows] - book.entries[entry]
        code[rows], error[rows] = book.index[entry], np.einsum("ij,ij->i", gap, gap)

    def compared(rows: np.ndarray, entries: np.ndarray, d: np.ndarray) -> None:
        code[rows], error[rows] = book.index[entries], d
    walk(tree, book, owned, compared)
    return code, error


# ---------------------------------------------------------------- Spark

def limit_for(dims: int) -> int:
    """The largest power of two at which squared distances over ``dims`` fit."""
    return 1 << ((62 - max(1, dims - 1).bit_length()) // 2 - 1)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None,
                  parts: int = PARTS, scale: float = SCALE) -> DataFrame:
    """(vec_id, label, x array<long>) of the usable vectors."""
    v = F.col("v")
    usable = v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"),
                          (F.col(label_col) if label_col else F.lit(None).cast("int")).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce(usable, F.lit(False)))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    dims = max(1, -(-(longest or 0) // parts)) * parts
    most = float(limit_for(dims))

    def whole(e: Column) -> Column:
        return F.greatest(F.least(F.floor(F.greatest(F.least(e, F.lit(most)), F.lit(-most)) * scale).cast("double"),
                                  F.lit(most)), F.lit(-most)).cast("long")
    filled = F.concat(F.transform("v", whole), F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v")))
    return rows.select("vec_id", "label", filled.alias("x"))


def plant(rows: DataFrame, chunk: int = CHUNK, parts: int = PARTS) -> DataFrame:
    """(chunk, members, trees): the chunks' rows and trees, written. Rows are
    dealt by their place in the written table, so neither a label nor a group
    of equal vectors fills a chunk; a chunk has about ``chunk`` rows."""
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "code-vectors")
    chunks = max(1, -(-numbered.count() // chunk))
    dealt = numbered.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    held = dealt.groupBy("chunk").agg(F.collect_list(F.struct("vec_id", "label", "x")).alias("members"))

    @F.pandas_udf("binary")
    def trees(members: pd.Series) -> pd.Series:
        return pd.Series([_planted(m, parts) for m in members])
    return written(held.withColumn("trees", trees(F.transform("members", lambda m: m["x"])))
                   .withColumn("members", F.transform("members", lambda m: F.struct(m["vec_id"].alias("vec_id"),
                                                                                   m["label"].alias("label")))), "code-trees")


def _planted(members, parts: int) -> bytes:
    points = np.array([np.asarray(m, np.int64) for m in members])
    return pickle.dumps([build(np.ascontiguousarray(p)) for p in np.split(points, parts, axis=1)])


def first_entries(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray:
    """parts x entries x length: the vectors of the smallest ids (repeated ids
    by their vector), one bounded row set for the driver."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.col("x").asc()).limit(entries).select("x").collect()
    table = np.array([r.x for r in first], np.int64)
    return np.stack(np.split(table, parts, axis=1)) if len(table) else np.empty((parts, 0, 0), np.int64)


def refined(planted: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: componentwise floor of the mean of each
    entry's parts; entries without a part stay."""
    parts, entries, length = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = [_Book(b) for b in books]
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for held in batch["trees"]:
                for p, tree in enumerate(pickle.loads(held)):
                    tallies(tree, ready[p], sums[p], counts[p])
        p, e = np.nonzero(counts)
        if len(p):
            yield pd.DataFrame({"place": p * entries + e, "n": counts[p, e], "s": list(sums[p, e])})

    found = planted.select("trees").mapInPandas(run, "place long, n long, s array<long>")
    total = (found.select("place", "n", F.posexplode("s").alias("at", "s")).groupBy("place", "at")
             .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas())
    out = books.reshape(parts * entries, length).copy()
    out[total["place"].to_numpy(), total["at"].to_numpy()] = total["s"].to_numpy() // total["n"].to_numpy()
    return out.reshape(books.shape)


def fit(rows: DataFrame, planted: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after all rounds."""
    books = first_entries(rows, entries, parts)
    for _ in range(rounds if books.size else 0):
        books = refined(planted, books)
    return books


def encode(planted: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row; two hex digits a part (more
    where a codebook has over 256 entries)."""
    digits = max(2, len(f"{max(1, books.shape[1]) - 1:x}"))

    @F.pandas_udf("array<struct<code:string,error:long>>")
    def coded(trees: pd.Series) -> pd.Series:
        ready = [_Book(b) for b in books]
        out = []
        for held in trees:
            found = [nearest(tree, ready[p]) for p, tree in enumerate(pickle.loads(held))]
            codes, errors = np.stack([c for c, _ in found], 1), sum(e for _, e in found)
            out.append([{"code": "".join(f"{x:0{digits}x}" for x in c), "error": int(e)}
                        for c, e in zip(codes.tolist(), errors.tolist())])
        return pd.Series(out)
    both = planted.select(F.explode(F.arrays_zip("members", coded("trees").alias("found"))).alias("m"))
    return both.select("m.members.vec_id", "m.members.label", "m.found.code", "m.found.error")


def digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
             entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable
    vector. Labels are added up per label first; the small table of labels
    meets the rows by an equi-join, broadcast or split by its real size."""
    rows = written(whole_vectors(vectors, id_col, vector_col, label_col, parts), "code-rows")
    planted = plant(rows, chunk, parts)
    books = fit(rows, planted, entries, parts, rounds)
    coded = written(encode(planted, books), "codes")
    by_label = written(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "code-labels") \
        .withColumnRenamed("label", "of")
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
