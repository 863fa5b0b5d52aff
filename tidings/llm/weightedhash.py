"""Near-duplicate documents by improved consistent weighted sampling.

1. Document frequencies of five-word shingles are counted exactly, per shingle,
   over all documents. A shingle weighs (1 + ln tf) (1 + idf) / 2, idf scaled
   to 0..1: rare shingles count up to twice as much as ubiquitous ones, so an
   edit in a member of a large group of copies does not outweigh what the
   group shares. Above ``REFERENCE`` documents a frequency counts per
   ``REFERENCE`` documents, and as 1 at least, so a passage weighs the same in
   a corpus of any size. Shingles above 1 are shared with the tasks: at most
   ``REFERENCE`` times the mean number of shingles of a document.
2. Each distinct text gets ``BANDS`` x ``ROWS`` samples: for a shingle of
   weight w, with r, c ~ Gamma(2, 1) and b ~ U(0, 1) fixed by shingle and
   sample number, t = floor(ln w / r + b), ln a = ln c - r (t - b + 1); the
   sample is the (shingle, t) of the least a, recognised by that least value.
   Two texts agree in a sample with the probability of their weighted
   Jaccard similarity.
3. Texts that agree in a whole band share a bucket. Equal texts are one
   class; a class is named by its smallest id.
4. Every member of a bucket is verified against the bucket's smallest one:
   weighted Jaccard similarity over the whole texts. Buckets whose members
   are then all connected are done: links among them cannot change a
   component. In the others every pair from different components is compared
   by its samples, in blocks, and pairs that agree in at least half of them
   are verified there (at similarity 0.8 and 70 samples, fewer agree with a
   probability below 1e-8). Pairs are not written out, so output stays linear
   in a group; nothing caps buckets, members or pairs.

Null and empty texts and texts without a word link only with equal ones (null
texts with nothing). Rows with a null id are never linked. Rows that share an
id are one document in the links. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.graph import components
from tidings.llm.shingles import SIZE, mix, shingles
from tidings.session import written

SIMILARITY = 0.8
BANDS, ROWS = 14, 5
REFERENCE = 10_000
HELD = 1 << 20  # shingles of a task that are combined at once
AGREE = 0.5
BLOCK = 128
CHUNK = 1 << 14
BATCH_CHARS = 1 << 18


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield start, len(texts)


class Idf:
    """ln-scaled idf, 0..1, of shingles: frequent ones by hash, the rest alike."""

    def __init__(self, h: np.ndarray, df: np.ndarray, n: int):
        size = min(n, REFERENCE)
        scaled = np.maximum(1.0, np.append(df, 0) * (size / max(n, 1)))
        value = np.log((1 + size) / (1 + scaled)) / max(np.log(1 + size), 1e-9)
        order = h.argsort()
        self.h, self.value, self.rest = h[order], value[:-1][order].astype(np.float32), max(0.0, float(value[-1]))

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.full(len(h), self.rest)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.value[at], self.rest)


def shingle_frequencies(docs: DataFrame) -> Idf:
    """The idf of each shingle, from exact counts over all texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def combined() -> pd.DataFrame:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"h": h.view(np.int64), "n": n})

        for b in batches:
            whole = b["text"].tolist()
            for i, j in _slices(whole):
                h = shingles(whole[i:j])[1]  # once per text
                held.append(h)
                size += len(h)
                if size >= HELD:
                    yield combined()
                    size = 0
        if size:
            yield combined()

    texts = docs.select("text").where("text IS NOT NULL")
    n = texts.count()
    rows = (texts.mapInPandas(count, "h long, n long").repartition("h").groupBy("h").agg(F.sum("n").alias("n"))
            .where(F.col("n") > max(1.0, n / REFERENCE)).toPandas())  # at most REFERENCE x shingles of a text
    return Idf(rows["h"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.float64), n)


def weights(h: np.ndarray, count: np.ndarray, idf: Idf | np.ndarray) -> np.ndarray:
    """``idf`` as an array is a table of hashed shingles."""
    found = idf.of(h) if isinstance(idf, Idf) else idf[(h % np.uint64(len(idf))).astype(np.int64)]
    return (1 + np.log(count)) * (1 + found) / 2


@lru_cache(maxsize=1)
def _gamma() -> np.ndarray:
    """4096 quantiles of Gamma(2, 1), by bisection of 1 - (1 + x) exp(-x)."""
    p = (np.arange(4096) + 0.5) / 4096
    low, high = np.zeros(4096), np.full(4096, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        under = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(under, x, low), np.where(under, high, x)
    return low.astype(np.float32)


def samples(text: np.ndarray, h: np.ndarray, w: np.ndarray, n_texts: int) -> np.ndarray:
    """(text, sample) the least ln a, as 32 bits; text is sorted. Texts
    without a shingle get the number of infinity."""
    k = BANDS * ROWS
    least = np.full((k, n_texts), np.inf, np.float32)
    gamma = _gamma()
    for i in range(0, len(h), CHUNK):
        part, hashes = text[i:i + CHUNK], mix(h[i:i + CHUNK])
        log_w = np.log(w[i:i + CHUNK]).astype(np.float32)
        where = np.flatnonzero(np.diff(part, prepend=-1))
        owner = part[where]
        for s in range(k):
            z = mix(hashes + np.uint64((s + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            r = gamma[(z & np.uint64(4095)).astype(np.int64)]
            b = ((z >> np.uint64(12)) & np.uint64(4095)).astype(np.float32) * np.float32(1 / 4096)
            u = (((z >> np.uint64(24)) & np.uint64(0xFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2 ** -20)
            v = ((z >> np.uint64(44)).astype(np.float32) + np.float32(0.5)) * np.float32(2 ** -20)
            log_a = np.log(-np.log(u * v)) - r * (np.floor(log_w / r + b) - b + 1)
            least[s, owner] = np.minimum(least[s, owner], np.minimum.reduceat(log_a, where))
    return np.ascontiguousarray(least.T).view(np.uint32)


def sampled(docs: DataFrame, idf: Idf | np.ndarray) -> DataFrame:
    """(id, k1, k2, sample): a digest of the text and its samples (null where
    the text has no word)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            whole = b["text"].tolist()
            out: list[bytes | None] = []
            for i, j in _slices(whole):
                text, h, count = shingles(whole[i:j])
                found = samples(text, h, weights(h, count, idf), j - i)
                some = np.bincount(text, minlength=j - i) > 0
                out.extend(x.tobytes() if s else None for x, s in zip(found, some))
            yield pd.DataFrame({"id": b["id"], "k1": b["k1"], "k2": b["k2"], "sample": pd.Series(out, dtype=object, index=b.index)})

    return (docs.select("id", F.xxhash64(F.lit(1), "text").alias("k1"), F.xxhash64(F.lit(2), "text").alias("k2"), "text")
            .mapInPandas(run, "id long, k1 long, k2 long, sample binary"))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (sorted hashes, weights)."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[at] == ha
    shared = np.minimum(wa[both], wb[at[both]]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def verify(pairs: DataFrame, texts: DataFrame, idf: Idf | np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) pairs -> those whose whole texts are similar, with sim. ``texts``
    has one text per id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for start, end in _slices([x + y for x, y in zip(batch["text_a"], batch["text_b"])]):
                b = batch.iloc[start:end]
                codes, distinct = pd.factorize(pd.concat([b["text_a"], b["text_b"]]))
                text, h, count = shingles(list(distinct))
                w = weights(h, count, idf)
                ends = np.searchsorted(text, np.arange(len(distinct) + 1))
                sets = [(h[s:e], w[s:e]) for s, e in zip(ends, ends[1:])]
                for x, y, i, j in zip(b["a"], b["b"], codes[:len(b)], codes[len(b):]):
                    rows.append((x, y, weighted_jaccard(sets[i], sets[j])))
            yield pd.DataFrame(rows, columns=["a", "b", "sim"])

    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.mapInPandas(run, "a long, b long, sim double").where(F.col("sim") >= similarity)


def band_members(classes: DataFrame) -> DataFrame:
    """(band, id, sample): the hashed band of each class, numbered by band."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = np.frombuffer(b"".join(b["sample"]), np.uint32).reshape(len(b), BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(b), BANDS)).copy()
            for r in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
            yield pd.DataFrame({"id": b["id"], "bands": list(key.view(np.int64))})

    return classes.select("id", "sample").mapInPandas(run, "id long, bands array<long>") \
        .select(F.explode("bands").alias("band"), "id")


class Union:
    """Union-find over component labels, the smallest label the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def _columns(b: pd.DataFrame, idf: Idf | np.ndarray) -> dict:
    """A block's rows: ids, component labels, samples, bands, weighted sets."""
    whole, sets = b["text"].tolist(), []
    for i, j in _slices(whole):
        text, h, count = shingles(whole[i:j])
        w = weights(h, count, idf)
        ends = np.searchsorted(text, np.arange(j - i + 1))
        sets.extend((h[s:e], w[s:e]) for s, e in zip(ends, ends[1:]))
    bands = np.zeros((len(b), BANDS), np.int64)
    for row, own in zip(bands, b["bands"]):
        row[:len(own)] = own
    return {"id": b["id"].to_numpy(), "component": b["component"].to_numpy(), "bands": bands, "sets": sets,
            "sample": np.frombuffer(b"".join(b["sample"]), np.uint32).reshape(len(b), -1)}


def _links(band: int, x: dict, y: dict, same: bool, union: Union, similarity: float) -> list[tuple[int, int]]:
    """Links between rows of x and y (the same rows if ``same``) that join
    components. Of the bands that a pair shares, one, chosen by hash, has it."""
    agree = np.zeros((len(x["id"]), len(y["id"])), np.int16)
    for s in range(x["sample"].shape[1]):
        agree += x["sample"][:, s, None] == y["sample"][None, :, s]
    agree = (agree >= AGREE * x["sample"].shape[1]) & (x["component"][:, None] != y["component"][None, :])
    i, j = np.nonzero(np.triu(agree, 1) if same else agree)
    out = []
    for at in range(0, len(i), 1 << 16):
        p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        shared = (x["bands"][p][:, :, None] == y["bands"][q][:, None, :]).any(2) & (x["bands"][p] != 0)
        pair = mix(x["id"][p].view(np.uint64)) ^ mix(y["id"][q].view(np.uint64))  # the same for either order
        rank = mix(x["bands"][p].view(np.uint64) ^ pair[:, None])
        chosen = np.where(shared, rank, np.uint64(0xFFFFFFFFFFFFFFFF)).argmin(1)
        mine = x["bands"][p, chosen] == band
        for k, m in zip(p[mine].tolist(), q[mine].tolist()):
            c, d = int(x["component"][k]), int(y["component"][m])
            if union.find(c) != union.find(d) and weighted_jaccard(x["sets"][k], y["sets"][m]) >= similarity:
                union.join(c, d)
                out.append((int(x["id"][k]), int(y["id"][m])))
    return out


def links_across(members: DataFrame, idf: Idf | np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """(band, id, component, sample, bands, text) -> links (a, b) that join
    components, found among all pairs of a band and different components that
    agree in at least ``AGREE`` of their samples.

    Each band is cut into blocks of bounded size; a block meets its own rows
    and, as a stream, those of the later blocks. Pairs are compared where they
    meet and never written out: a block gives at most one link per component.
    """
    blocks = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (members.join(blocks, "band").withColumn("own", own)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("own")))).withColumn("kind", (F.col("block") < F.col("own")).cast("int"))
             .select("band", "block", "kind", "id", "component", "sample", "bands", "text")
             .repartition("band", "block").sortWithinPartitions("band", "block", "kind", "id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, whole, union = None, [], None, Union()
        out: list[tuple[int, int]] = []

        def gather() -> dict | None:
            if held and whole is None:
                block = _columns(pd.concat(held), idf)
                out.extend(_links(key[0], block, block, True, union, similarity))
                return block
            return whole

        for batch in batches:
            for k, b in batch.groupby(["band", "block"], sort=False):
                if k != key:
                    whole = gather()
                    key, held, whole, union = k, [], None, Union()
                if (b["kind"] == 0).any():
                    held.append(b[b["kind"] == 0])
                b = b[b["kind"] == 1]
                if len(b) and held:
                    whole = gather()
                    out.extend(_links(key[0], _columns(b, idf), whole, False, union, similarity))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
                out.clear()
        gather()
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])

    return dealt.mapInPandas(run, "a long, b long").distinct()


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: id, n_copies (rows with the same text, itself
    included), component_id (the smallest id reachable by links), kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    usable = rows.where("id IS NOT NULL AND text IS NOT NULL")
    idf = shingle_frequencies(rows)
    every = written(sampled(usable, idf), "samples")
    classes = written(every.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"),
                                                    F.first("sample").alias("sample")), "classes")
    nodes = classes.where("sample IS NOT NULL").select(F.col("rep").alias("id"), "sample")
    bands = written(band_members(nodes), "bands")
    buckets = written(bands.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
                      .where("leader <> last").select("band", "leader"), "buckets")
    bands = written(bands.join(buckets, "band"), "bands-shared")

    first = bands.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    first = written(first, "pairs")
    needed = written(bands.select("id").distinct(), "candidates")
    texts = written(usable.join(needed, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "candidate-texts")
    links = written(verify(first, texts, idf, similarity), "links-to-leaders")
    joined = written(components(links.select("a", "b")), "first-components")

    labelled = bands.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_bands = (labelled.groupBy("band").agg(F.min("component").alias("c1"), F.max("component").alias("c2"),
                                               F.count(F.lit(1)).alias("size"))
                  .where("c1 <> c2 AND size > 2").select("band"))
    members = written(labelled.join(open_bands, "band").select("band", "id", "component"), "open-bands")
    meeting = (members.groupBy("id", "component").agg(F.collect_list("band").alias("bands"))  # at most BANDS of them
               .join(nodes, "id").join(texts, "id")
               .select("component", "id", "sample", "bands", "text", F.explode("bands").alias("band")))
    more = written(links_across(meeting, idf, similarity), "links-across")
    joined = components(links.select("a", "b").unionByName(more))

    named = classes.join(joined.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("k1", "k2", "n", F.coalesce("component", "rep").alias("component_id"))
    found = (every.select("id", "k1", "k2").join(named, ["k1", "k2"])
             .select("id", F.col("n").alias("n_copies"), "component_id"))
    alone = rows.where("id IS NULL OR text IS NULL") \
        .select("id", F.lit(1).cast("long").alias("n_copies"), F.col("id").alias("component_id"))
    return (found.unionByName(alone)
            .select(F.col("id").alias(id_col), "n_copies", "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents with one of each group left, the one with the smallest
    id; of rows that share an id one stays. Rows with a null id stay."""
    found = written(near_documents(docs, id_col, text_col, similarity).where(F.col(id_col).isNotNull()), "near-documents")
    gone = written(found.where(~F.col("kept")).select(id_col).distinct(), "near-dropped")
    twice = written(found.where("kept").groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col), "near-repeated")
    left = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    return (left.join(twice, id_col, "left_anti").select(*docs.columns)
            .unionByName(left.join(twice, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col])))
