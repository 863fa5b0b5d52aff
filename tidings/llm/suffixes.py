"""Exact repeats of fixed length, by the Burrows-Wheeler transform and common
prefixes of document collections, built column by column.

A byte is covered if a string of ``length`` bytes over it starts anywhere else
too. Equal strings have equal anchors: the hash-smallest substring of
``length - SPAN`` bytes among those inside the string, the leftmost of equals.
So the strings of a text fall into runs with one anchor, and a run whose anchor
hash occurs nowhere else cannot repeat. The remaining runs become documents of
a collection: bytes before the anchor, a name of the anchor of four symbols,
bytes behind it. Equal runs are counted before they move and enter as one
document that is its own neighbour.

Collections (sets of whole anchor groups of bounded size) are built as
described for large sets of short strings: round j inserts the j-th symbol from
the right of every document at once, so the transform holds all suffixes of up
to j symbols; the place of each new suffix is the rank of its symbol, its common
prefix with its neighbours the minimum between the symbol's occurrences plus
one. A table in the shared checkpoint folder holds each collection's transform,
common prefixes and places; a pass reads it in sequence, inserts ``COLUMNS``
symbols per document and writes the next one, so a lost executor repeats one
pass of one collection. In the end every document walks its suffixes, and those
that share SPAN + 4 symbols with a neighbour are repeated strings.

Hot anchors: a group of more than ``GROUP`` distinct runs is halved by the
anchor's place in the string. Each half is keyed by the bytes that all its
strings have in common, longer than the anchor, so runs that merely share the
anchor part. Halving ends at one place, where a group is one string. Nothing is
dropped or capped; one key never fills a task.

Texts are taken once per distinct text (equal texts count as two), in a table
bucketed by the text's digest, so that anchors and spans meet the texts without
moving them again. Null text is empty. Texts shorter than ``length`` are kept
whole; very long ones are scanned in overlapping slices. Repeated rows and ids,
null ids and extra columns of any name are carried; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import scratch_path, written

LENGTH = 200
SPAN = 72  # places an anchor can take, less one
GROUP = 2000  # distinct runs that may share a key
COLLECTION = 1 << 18  # bytes of documents built in one piece
COLUMNS = 96  # symbols inserted per pass
SLICE = 1 << 20  # bytes scanned at once
ROWS = 20_000  # rows of one frame that a task returns
MARK, END = 0xFE, 0xFF  # never in UTF-8


def span_for(length: int) -> int:
    return min(SPAN, length // 2)


# ---------------------------------------------------------------- anchors

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``size`` bytes, by doubling."""
    base = np.uint64(0x9E3779B97F4A7C15)
    block, power, length = data.astype(np.uint64) + np.uint64(1), np.array([base]), 1
    out, have, shift = None, 0, np.array([np.uint64(1)])
    with np.errstate(over="ignore"):
        while True:
            if size & length:  # this block, then what the smaller ones cover
                n = len(data) - (have + length) + 1
                out = block if out is None else block[:n] * shift + out[length:length + n]
                have, shift = have + length, shift * power
            if length * 2 > size:
                return _mixed(out)
            block, power, length = block[:-length] * power + block[length:], power * power, length * 2


def runs(data: np.ndarray, length: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, anchor, first, last): runs of strings with one anchor; ``first``
    and ``last`` are where the first and last string of the run start."""
    h = window_hashes(data, length - span)
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= span + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span + 1:
        extra = span + 1 - size
        least = np.minimum(least[:-extra], least[extra:])
    at = (least & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    return h[at[first]], at[first], first, last


def scan(text: bytes, length: int, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``runs`` of a whole text; a run cut by a slice's end goes on as two."""
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data) - length + 1, SLICE):
        part = data[start:start + SLICE + length - 1]
        h, at, first, last = runs(part, length, span)
        yield h, at + start, first + start, last + start


def _pack(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Anchor and the run's first and last place of it in the string."""
    return (at << 16) | ((at - first) << 8) | (at - last)


# ---------------------------------------------------------------- collections

def new_collection(docs: list[bytes], twins=None) -> dict:
    """Round 0: the suffixes that are a document's end alone, in the order of
    the documents; each is preceded by the document's last symbol. ``twins``
    tells which documents stand for two or more equal ones: there every suffix
    has an equal neighbour."""
    ends = np.cumsum([len(d) for d in docs])
    symbols = np.frombuffer(b"".join(docs), np.uint8)
    starts = np.concatenate(([0], ends[:-1]))
    return {"bwt": symbols[ends - 1].copy(), "lcp": np.zeros(len(docs), np.uint8), "at": np.arange(len(docs)),
            "left": ends - 1 - starts, "symbols": symbols, "starts": starts, "docs": len(docs),
            "twins": np.zeros(len(docs), bool) if twins is None else np.asarray(twins, bool)}


def _keys(bwt: np.ndarray) -> np.ndarray:
    """The transform as sorted (symbol, position) pairs of 8 and 24 bits."""
    order = np.argsort(bwt, kind="stable")
    return (bwt[order].astype("u4") << np.uint32(24)) | order.astype("u4")


def _minima(lcp: np.ndarray, before: np.ndarray, p: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """min(lcp[before + 1:p + 1]) and min(lcp[p + 1:after + 1]) where before < p < after.
    ``p`` falls, so the stretch between two intervals is never read."""
    edges = np.stack((np.minimum(before, p - 1) + 1, p + 1, after + 1), 1).ravel()
    out = np.minimum.reduceat(np.append(lcp, np.uint8(0)), edges)
    return out[::3], out[1::3]


def insert_columns(c: dict, rounds: int) -> dict:
    """Inserts up to ``rounds`` more symbols of every document that has any.
    ``at`` is where the document's last inserted suffix lies (-1: complete).

    A suffix goes where its symbol ranks among equal symbols of the transform,
    so its pair's index in ``_keys`` is its place behind the documents' ends."""
    lcp, left, symbols, starts, docs = c["lcp"], c["left"].copy(), c["symbols"], c["starts"], c["docs"]
    keys, low, high = _keys(c["bwt"]), np.uint32((1 << 24) - 1), np.uint32(24)
    doc = np.flatnonzero(c["at"] >= 0)
    k = np.searchsorted(keys, (c["bwt"][c["at"][doc]].astype("u4") << high) | c["at"][doc].astype("u4"))
    byplace = np.argsort(k)
    doc, k = doc[byplace], k[byplace]
    bypos = np.argsort(keys[k] & low)  # documents by the place of their last suffix
    for _ in range(rounds):
        if not len(doc):
            break
        pair, before, after = keys[k], keys[np.maximum(k - 1, 0)], keys[np.minimum(k + 1, len(keys) - 1)]
        has_before, has_after = (k > 0) & (before >> high == pair >> high), (k + 1 < len(keys)) & (after >> high == pair >> high)
        down = bypos[::-1]
        low_up, low_down = _minima(lcp, *((x[down] & low).astype(np.int64) for x in (
            np.where(has_before, before, pair), pair, np.where(has_after, after, pair))))
        up, after_up = np.empty(len(k), np.uint8), np.empty(len(k), np.uint8)
        up[down], after_up[down] = low_up, low_down
        up = np.where(has_before, up + np.uint8(1), np.uint8(0))
        put, more = docs + k, left[doc] > 0
        ahead = np.full(len(k), END, np.uint8)
        ahead[more] = symbols[starts[doc[more]] + left[doc[more]] - 1]
        # what lies behind a new suffix moves on
        behind = np.diff(np.concatenate(([0], put - np.arange(len(put)), [len(keys)])))
        steps = np.arange(len(put) + 1, dtype="u2" if len(put) < 1 << 16 else "u4")  # short, so that gathering stays in the cache
        keys += np.repeat(steps, behind).take((keys & low).astype(np.intp), mode="clip")
        order = np.argsort(ahead, kind="stable")  # places rise; the complete documents come last
        new = (ahead[order].astype("u4") << high) | put[order].astype("u4")
        k = np.searchsorted(keys, new) + np.arange(len(new))
        old = np.ones(len(keys) + len(new), bool)
        old[k] = False
        grown = np.empty(len(old), "u4")
        grown[old], grown[k] = keys, new
        keys = grown
        old[k] = True
        old[put] = False
        prefixes = np.empty(len(old), np.uint8)
        prefixes[old], prefixes[put] = lcp, up
        prefixes[put[has_after] + 1] = after_up[has_after] + np.uint8(1)
        lcp = prefixes
        left[doc] -= 1
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        bypos, on = rank[more], more[order]
        doc, k = doc[order][on], k[on]
    bwt = np.empty(len(keys), np.uint8)
    bwt[keys & low] = keys >> high
    at = np.full(docs, -1)
    at[doc] = keys[k] & low
    return {**c, "bwt": bwt, "lcp": lcp, "at": at, "left": left}


def repeated_suffixes(c: dict, common: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(suffix length, documents, flags): whether the suffix shares ``common``
    symbols with a neighbour. Every document walks from its end to its start."""
    order = np.argsort(c["bwt"], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    near = c["lcp"] >= common
    flags = near.copy()
    flags[:-1] |= near[1:]
    at, docs, size = np.arange(c["docs"]), np.arange(c["docs"]), 0
    while len(docs):
        if size >= common:
            yield size, docs, flags[at] | c["twins"][docs]
        on = c["bwt"][at] != END
        docs, at, size = docs[on], c["docs"] + rank[at[on]], size + 1


# ---------------------------------------------------------------- Spark

def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(id, t, text, copies): every distinct text once, in a table bucketed by
    its digest with as many buckets as the session has shuffle partitions."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    one = rows.groupBy(_digest(F.col("text")).alias("t")).agg(
        F.first("text").alias("text"), F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies"))
    one = one.withColumn("id", F.monotonically_increasing_id())
    name, buckets = f"texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    (one.write.bucketBy(buckets, "t").option("compression", "zstd").option("path", scratch_path(spark, name))
     .saveAsTable(name))
    return spark.table(name)


def anchors(texts: DataFrame, length: int, span: int) -> DataFrame:
    """(id, copies, hash, at) of every run of every text."""
    def frame(held: list) -> pd.DataFrame:
        n = [len(h) for _, _, h, _ in held]
        return pd.DataFrame({"id": np.repeat(np.array([t for t, *_ in held], np.int64), n),
                             "copies": np.repeat(np.array([c for _, c, *_ in held], np.int32), n),
                             "hash": np.concatenate([h for _, _, h, _ in held]).view(np.int64),
                             "at": np.concatenate([a for *_, a in held])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for batch in batches:
            for i, text, copies in zip(batch["id"], batch["text"], batch["copies"]):
                for h, at, first, last in scan(text.encode(), length, span):
                    held.append((i, copies, h, _pack(at, first, last)))
                    rows += len(h)
                if rows >= ROWS:
                    yield frame(held)
                    held, rows = [], 0
        if held:
            yield frame(held)
    return texts.select("id", "text", "copies").mapInPandas(run, "id long, copies int, hash long, at long")


def _beside(texts: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """``lists`` (keyed by the text's id) beside the texts: only ids move, as
    the texts lie in buckets of the digest that the second join is by. The
    short lists of a bucket are hashed, so its texts need no sort."""
    named = lists.join(texts.select("id", "t"), "id").drop("id")
    return texts.join(named.hint("shuffle_hash"), "t", how)


def _cut(data: bytes, packed: int, length: int, span: int) -> tuple[bytes, bytes, bytes, bytes]:
    """A run's digest, its anchor's digest, its bytes before and behind the anchor."""
    at, high, low = packed >> 16, packed >> 8 & 255, packed & 255
    key = hashlib.md5(data[at:at + length - span]).digest()
    left, right = data[at - high:at], data[at + length - span:at + length - low]
    return hashlib.md5(key + bytes([high]) + left + right).digest(), key, left, right


def occurrences(texts: DataFrame, found: DataFrame, length: int, span: int) -> DataFrame:
    """(id, at, copies, run, key) of the runs whose anchor hash occurs more
    than once: the digests of the run and of its anchor."""
    often = found.groupBy("hash").agg(F.sum("copies").alias("n")).where("n > 1").select("hash")
    # distinct hashes spread evenly; written, so that rows of a hot one are split at run time
    often = written(often, "suffix-often").hint("shuffle_hash")
    wanted = found.join(often, "hash").groupBy("id").agg(F.collect_list("at").alias("ats"))

    def frame(held: list, cuts: list) -> pd.DataFrame:
        n = [len(ats) for *_, ats in held]
        return pd.DataFrame({"id": np.repeat(np.array([i for i, *_ in held], np.int64), n),
                             "at": np.concatenate([ats for *_, ats in held]),
                             "copies": np.repeat(np.array([c for _, c, _ in held], np.int32), n),
                             "run": [run for run, *_ in cuts], "key": [key for _, key, *_ in cuts]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, cuts = [], []
        for batch in batches:
            for i, text, copies, ats in zip(batch["id"], batch["text"], batch["copies"], batch["ats"]):
                data = text.encode()
                held.append((i, copies, ats))
                cuts += [_cut(data, at, length, span) for at in ats.tolist()]
                if len(cuts) >= ROWS:
                    yield frame(held, cuts)
                    held, cuts = [], []
        if held:
            yield frame(held, cuts)
    return _beside(texts, wanted).select("id", "text", "copies", "ats").mapInPandas(
        run, "id long, at long, copies int, run binary, key binary")


def distinct_runs(seen: DataFrame, span: int) -> DataFrame:
    """(run, key, n, id, at): every distinct run once, its number (2 stands
    for all that is more) and one place to read it from."""
    one = seen.groupBy("run").agg(F.first("key").alias("key"), F.least(F.sum("copies"), F.lit(2)).cast("int").alias("n"),
                                  F.min(F.struct("id", "at")).alias("w"))
    return one.select("run", "key", "n", "w.id", "w.at")


def contents(texts: DataFrame, distinct: DataFrame, length: int, span: int) -> DataFrame:
    """(run, key, left, right, n): distinct runs with their bytes around the anchor."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for text, places in zip(batch["text"], batch["places"]):
                data = text.encode()
                rows += [(*_cut(data, p["at"], length, span), p["n"]) for p in places]
                if len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=["run", "key", "left", "right", "n"])
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["run", "key", "left", "right", "n"])
    lists = distinct.groupBy("id").agg(F.collect_list(F.struct("at", "n")).alias("places"))
    return _beside(texts, lists).select("text", "places").mapInPandas(
        run, "run binary, key binary, left binary, right binary, n int")


def _piece() -> Column:
    return F.unhex(F.md5(F.concat("key", F.unhex(F.lpad(F.hex(F.length("left")), 2, "0")), "left", "right")))


def split_hot(rows: DataFrame, group: int, span: int) -> DataFrame:
    """(run, piece, key, left, right, n) of the ``rows`` (run, key, left, right,
    n) of hot keys, halved until no key has more than ``group`` distinct rows.
    Keys that occur once are left out: nothing in them repeats."""
    todo = _halves(rows.withColumn("a", F.lit(0)).withColumn("b", F.lit(span)), span)
    done = []
    while True:
        todo = written(todo.withColumn("piece", _piece()), "suffix-halves")
        keys = todo.groupBy("key", "a", "b", "piece").agg(F.sum("n").alias("n")) \
            .groupBy("key").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("rows"))
        keys = written(keys.where("all > 1"), "suffix-keys")
        hot = (F.col("rows") > group) & (F.col("a") < F.col("b"))
        both = todo.join(keys, "key")
        done.append(both.where(~hot).select("run", "piece", "key", "left", "right", "n"))
        if keys.where(F.col("rows") > group).isEmpty():
            return reduce(DataFrame.unionByName, done)
        todo = _halves(both.where(hot), span)


def _halves(rows: DataFrame, span: int) -> DataFrame:
    """Each row once for the lower and once for the upper half of the anchor's
    places, keyed by the bytes that all strings of the half share."""
    high, low = F.length("left"), F.lit(span) - F.length("right")
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    cut = rows.withColumn("half", F.explode(F.array(
        F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b").alias("b")))))
    cut = cut.select("run", "key", "left", "right", "n", high.alias("high"), low.alias("low"), "half.a", "half.b") \
        .where((F.col("low") <= F.col("b")) & (F.col("high") >= F.col("a")))
    reach, back = F.least("high", "b"), F.greatest("low", "a")
    tail = lambda n: F.substring("left", F.col("high") - n + 1, n)
    lead = lambda n: F.substring("right", F.lit(1), n)
    shared = F.concat("key", F.encode(F.format_string("%d.%d", F.col("a"), F.col("b")), "UTF-8"),
                      tail(F.col("a")), lead(F.lit(span) - F.col("b")))
    return cut.select("run", F.unhex(F.md5(shared)).alias("key"), tail(reach).alias("left"),
                      lead(F.lit(span) - back).alias("right"), "n", "a", "b")


_STATE = "collection long, runs array<binary>, state binary"


def _freeze(c: dict) -> bytes:
    """The state of a collection: symbols already inserted are not kept."""
    left = np.maximum(c["left"], 0)
    starts = np.cumsum(left) - left
    todo = c["symbols"][np.repeat(c["starts"] - starts, left) + np.arange(left.sum())]
    return pickle.dumps({**c, "symbols": todo, "starts": starts})


def collections(rows: DataFrame, count: int) -> DataFrame:
    """(collection, runs, state) after round 0: the ``rows`` (piece, key, left,
    right, n) dealt into ``count`` collections, whole keys each. ``runs`` names
    the documents."""
    def start(frame: pd.DataFrame) -> pd.DataFrame:
        number, docs = {}, []
        for key, left, right in zip(frame["key"], frame["left"], frame["right"]):
            k = number.setdefault(key, len(number))
            docs.append(left + bytes([MARK, k // 62500 % 250, k // 250 % 250, k % 250]) + right)
        return pd.DataFrame({"collection": frame["collection"].iloc[:1].tolist(), "runs": [frame["piece"].tolist()],
                             "state": [_freeze(new_collection(docs, frame["n"] > 1))]})
    return rows.withColumn("collection", F.pmod(F.xxhash64("key"), F.lit(count))) \
        .groupBy("collection").applyInPandas(start, _STATE)


def _pass(state: DataFrame, columns: int) -> DataFrame:
    """The next ``columns`` symbols of every document of every collection."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.iloc[i:i + 1]
                yield row.assign(state=[_freeze(insert_columns(pickle.loads(row["state"].iloc[0]), columns))])
    return state.mapInPandas(run, _STATE)


def repeated_places(state: DataFrame, span: int) -> DataFrame:
    """(piece, a, b): for each document, the ranges of lengths of the suffixes
    whose string is repeated."""
    common = span + 4

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for names, held in zip(batch["runs"], batch["state"]):
                flagged = [(docs[flags], np.full(flags.sum(), size)) for size, docs, flags in repeated_suffixes(pickle.loads(held), common)]
                if not flagged:
                    continue
                docs, sizes = (np.concatenate(x) for x in zip(*flagged))
                order = np.lexsort((sizes, docs))
                docs, sizes = docs[order], sizes[order]
                apart = (docs[1:] != docs[:-1]) | (sizes[1:] != sizes[:-1] + 1)
                first, last = np.append(True, apart)[:len(docs)], np.append(apart, True)[:len(docs)]
                if len(docs):
                    yield pd.DataFrame({"piece": names[docs[first]], "a": sizes[first], "b": sizes[last]})
    return state.mapInPandas(run, "piece binary, a int, b int")


def repeats(texts: DataFrame, seen: DataFrame, length: int, span: int, group: int = GROUP, columns: int = COLUMNS,
            size: int = COLLECTION) -> DataFrame:
    """(run, a, b): ranges of places of the anchor at which strings of the run repeat."""
    distinct = written(distinct_runs(seen, span), "suffix-distinct")
    hot = written(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > group).select("key"),
                  "suffix-hot")
    low = F.col("at").bitwiseAND(F.lit(255)).cast("int")
    cool = distinct.join(hot, "key", "left_anti")
    rows = contents(texts, cool, length, span).withColumn("piece", F.col("run"))
    named = cool.select("run", F.col("run").alias("piece"), (F.lit(span) - low).alias("behind"))
    total = distinct.agg(F.sum(F.shiftright("at", 8).bitwiseAND(F.lit(255)) + F.lit(span + 4) - low)).first()[0] or 0
    fields = ["piece", "key", "left", "right", "n"]
    rows = rows.select(fields)
    if not hot.isEmpty():
        halves = split_hot(contents(texts, distinct.join(hot, "key", "left_semi"), length, span), group, span)
        halves = written(halves, "suffix-split")
        rows = rows.unionByName(halves.groupBy("piece", "key", "left", "right").agg(
            F.least(F.sum("n"), F.lit(2)).cast("int").alias("n")).select(fields))
        named = named.unionByName(halves.select("run", "piece", F.length("right").alias("behind")))
    state = written(collections(rows, max(1, -(-total // size))), "suffix-pass")
    passes = -(-(2 * span + 4) // columns)
    for _ in range(passes - 1):
        state = written(_pass(state, columns), "suffix-pass")
    places = written(repeated_places(_pass(state, columns), span), "suffix-places")
    # a suffix of s symbols holds the name, what is behind the anchor and the anchor's place
    place = lambda x: (x - F.col("behind") - F.lit(4)).cast("int")
    return (named.join(places.hint("shuffle_hash"), "piece")
            .select("run", place(F.col("a")).alias("a"), place(F.col("b")).alias("b")))


def text_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the distinct texts and, per text id, the byte ranges
    (from, to) of repeated strings, overlapping ones not yet joined."""
    span = span_for(length)
    texts = distinct_texts(docs, text_col)
    found = written(anchors(texts, length, span), "suffix-anchors")
    seen = written(occurrences(texts, found, length, span), "suffix-runs")
    hit = written(repeats(texts, seen, length, span, group), "suffix-repeats")
    at = F.shiftright("at", 16)
    high, low = F.shiftright("at", 8).bitwiseAND(F.lit(255)), F.col("at").bitwiseAND(F.lit(255))
    spans = (seen.select("id", "at", "run").join(hit.hint("shuffle_hash"), "run").where((F.col("a") <= high) & (F.col("b") >= low))
             .select("id", F.struct((at - F.least("b", high)).alias("a"), (at - F.greatest("a", low) + length).alias("b")).alias("s")))
    return texts, spans.groupBy("id").agg(F.collect_list("s").alias("spans"))


_RESULT = "t binary, n_bytes long, n_removed long, removed array<struct<a:long,b:long>>, kept binary, kept_sha256 string"


def clean_texts(texts: DataFrame, spans: DataFrame, with_text: bool = True) -> DataFrame:
    """(t, n_bytes, n_removed, removed, kept, kept_sha256) per distinct text;
    ``removed`` are the maximal runs, ``kept`` the bytes left."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, text, found in zip(batch["t"], batch["text"], batch["spans"]):
                data, joined = text.encode(), []
                for a, b in sorted((s["a"], s["b"]) for s in (found if found is not None else [])):
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], b)
                    else:
                        joined.append([a, b])
                edges = [0, *[x for pair in joined for x in pair], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((t, len(data), len(data) - len(kept), [{"a": a, "b": b} for a, b in joined],
                             kept if with_text else None, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["t", "n_bytes", "n_removed", "removed", "kept", "kept_sha256"])
    return _beside(texts, spans, "left").select("t", "text", "spans").mapInPandas(run, _RESULT)


def drop_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, group: int = GROUP,
                 with_text: bool = True) -> DataFrame:
    """The input's columns, then n_bytes, n_removed, removed (maximal runs),
    n_spans, kept (the bytes left, null without ``with_text``) and kept_sha256.
    Input columns of those names are replaced."""
    result = written(clean_texts(*text_spans(docs, text_col, length, group), with_text), "suffix-results")
    new = ["n_bytes", "n_removed", "removed", "n_spans", "kept", "kept_sha256"]
    kept = [c for c in docs.columns if c not in new]
    key, bundle = "t", "found"
    while key in docs.columns or bundle in docs.columns:
        key, bundle = key + "_", bundle + "_"
    result = result.select(F.col("t").alias(key), F.struct(
        *["n_bytes", "n_removed", "removed", F.size("removed").cast("long").alias("n_spans"), "kept", "kept_sha256"]).alias(bundle))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], _digest(F.col(f"`{text_col}`")).alias(key))
    return rows.join(result, key).select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"{bundle}.{c}").alias(c) for c in new])
