"""TF-IDF weights and cosine similarity as relational operators (M5-M7),
plus a skew-safe per-group top-k (O5-O7).

For each query's own best documents (O7) a stated set of queries meets blocks
of document vectors as a stream. The best documents for any of many queries
(M6) come from an inverted index. Terms have one order, rarest first. A first
pass scores each query against the heaviest documents of its strongest terms;
the k-th best score found is a floor. A pair can only reach the floor if the
first term it shares is early enough in both vectors: what is left of the query
from there on, with the largest weight of each term in any document, must reach
it, and so must the product of the norms of what is left of both. Documents
without such a term are left out; the others are dealt into blocks, once each,
and postings are kept under such terms alone, inside a block: vectors are not
copied per term, and a query meets only the documents under its own terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.stopwords import ENGLISH_STOP_WORDS
from tidings.session import literal_table, written

TOKEN_PATTERN = r"(?U)\b\w\w+\b"  # tokens of at least two word characters
MAX_TERMS = 2000
TOP_K = 3
MIN_CORPUS = 5
DOC_BLOCK = 4096  # documents that meet queries in one group
ANY_BLOCK = 16384  # documents that the queries of best_of_any meet in one group
DENSE_ROW = 32  # making a dense row costs as much as so many products with one
CHAMPIONS = 4  # heaviest documents per term, for the floors
PROBES = 3  # strongest terms of a query, whose champions give its floor
SLACK = 1e-9  # scores are compared by 10 decimals
CHUNK = 1024  # documents that are dense at once


def tokens(text: Column) -> Column:
    """Lower-cased tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def vocabulary(docs: DataFrame, text_col: str, max_terms: int = MAX_TERMS, n_docs: int | None = None,
               stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """M5 vocabulary: the ``max_terms`` terms with the highest corpus
    frequency (ties by term) without stop words, with document frequency and
    the smoothed idf = ln((1 + n) / (1 + df)) + 1, n = number of corpus
    documents. One pass; counts combine map-side by (term, in a document)."""
    n = n_docs if n_docs is not None else docs.count()
    words = tokens(F.col(text_col))
    seen = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    held = docs.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stop = literal_table(docs.sparkSession, [(w,) for w in stop_words], "term string")
    top = seen.join(stop, "term", "left_anti").orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_terms)
    return top.join(held, "term").withColumn("idf", F.log((F.lit(1.0 + n)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)) \
        .withColumn("n_docs", F.lit(n).cast("long"))


def _vectors(texts: DataFrame, index: dict[str, int], idf: np.ndarray) -> DataFrame:
    """(q, c, w tokens) -> (q, c, kind, at, x): the non-zero places and values of
    the normalised tf-idf vector; texts without a term have none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            places, values = [], []
            for words in b["w"]:
                at, count = np.unique(np.array([index[w] for w in words if w in index], np.int32), return_counts=True)
                x = count * idf[at]
                places.append(at)
                values.append(x / np.sqrt((x * x).sum()) if len(x) else x.astype(np.float64))
            yield b.drop(columns="w").assign(at=pd.Series(places, dtype=object, index=b.index),
                                             x=pd.Series(values, dtype=object, index=b.index))

    types = {f.name: f.dataType.simpleString() for f in texts.schema}
    return texts.mapInPandas(run, f"q {types['q']}, c {types['c']}, kind int, at array<int>, x array<double>")


def _dense(rows: pd.DataFrame, terms: int) -> np.ndarray:
    out = np.zeros((len(rows), terms))
    for row, at, x in zip(out, rows["at"], rows["x"]):
        row[at] = x
    return out


def _best(q: np.ndarray, c: np.ndarray, similarity: np.ndarray, k: int) -> pd.DataFrame:
    """The best k of each query, by rounded similarity, then document."""
    found = pd.DataFrame({"q": q, "c": c, "similarity": similarity})
    return (found.assign(r=-found["similarity"].round(10)).sort_values(["q", "r", "c"]).groupby("q").head(k)
            .drop(columns="r"))


def _left_norm(x: np.ndarray) -> np.ndarray:
    """The norm of a vector from each of its places on."""
    return np.sqrt(np.cumsum((x * x)[::-1])[::-1])


def champions(docs: DataFrame, per_term: int = CHAMPIONS) -> DataFrame:
    """(c, at, x) -> (t, c, w, at, x): the ``per_term`` documents with the
    largest weight of each term. A task passes on its own best alone."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for b in batches:
            b = b[b["at"].map(len) > 0]
            if not len(b):
                continue
            row = np.repeat(np.arange(len(b)), b["at"].map(len))
            now = pd.DataFrame({"t": np.concatenate(b["at"].tolist()), "w": np.concatenate(b["x"].tolist()), "row": row})
            now = now.sort_values(["t", "w"], ascending=[True, False]).groupby("t").head(per_term)
            now = b.iloc[now["row"]].reset_index(drop=True).assign(t=now["t"].to_numpy(np.int32), w=now["w"].to_numpy())
            best = now if best is None else pd.concat([best, now], ignore_index=True)
            best = best.sort_values(["t", "w", "c"], ascending=[True, False, True]).groupby("t").head(per_term)
        if best is not None:
            yield best[["t", "c", "w", "at", "x"]]

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    held = docs.select("c", "at", "x").mapInPandas(run, f"t int, c {types['c']}, w double, at array<int>, x array<double>")
    return top_k_per_group(held, ["t"], [F.col("w").desc(), F.col("c").asc()], per_term).drop("rank")


def _floor(asked: DataFrame, heavy: DataFrame, most: np.ndarray, k: int) -> float:
    """No more than the k-th best score that a document has with any query; 0
    when fewer documents are known."""
    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(t=[at[np.argsort(-x * most[at], kind="stable")[:PROBES]] for at, x in zip(b["at"], b["x"])])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sims = []
            for at, x, c_at, c_x in zip(b["at"], b["x"], b["c_at"], b["c_x"]):
                _, i, j = np.intersect1d(at, c_at, assume_unique=True, return_indices=True)
                sims.append(float(x[i] @ c_x[j]))
            yield pd.DataFrame({"c": b["c"], "similarity": sims})

    c_type = heavy.schema["c"].dataType.simpleString()
    probed = asked.select("at", "x").mapInPandas(probes, "at array<int>, x array<double>, t array<int>")
    met = (probed.withColumn("t", F.explode("t"))
           .join(heavy.select("t", "c", F.col("at").alias("c_at"), F.col("x").alias("c_x")), "t")
           .mapInPandas(score, f"c {c_type}, similarity double"))
    best = met.groupBy("c").agg(F.max("similarity").alias("s")).orderBy(F.col("s").desc()).limit(k).collect()  # k numbers
    return min(r["s"] for r in best) - SLACK if len(best) == k else 0.0


def best_matches(queries: DataFrame, corpus: DataFrame, q_id: str, q_text: str, c_id: str, c_text: str, k: int,
                 max_terms: int = MAX_TERMS, n_docs: int | None = None) -> DataFrame:
    """Candidates for the ``k`` most similar documents: per block of documents
    the best k of each query (query, document, similarity).

    Documents are dealt into blocks of about ``DOC_BLOCK`` vectors; every query
    vector goes to every block, after the block's documents, and is multiplied
    with them in batches. Both texts are read once; no query reaches the
    driver, which holds the vocabulary of ``max_terms`` alone, and no (query,
    document) pair is shuffled.
    """
    n = n_docs if n_docs is not None else corpus.count()
    vocab = vocabulary(corpus, c_text, max_terms, n).select("term", "idf").orderBy("term").toPandas()
    index, idf = {t: i for i, t in enumerate(vocab["term"])}, vocab["idf"].to_numpy(np.float64)
    q_type, c_type = queries.schema[q_id].dataType.simpleString(), corpus.schema[c_id].dataType.simpleString()
    blocks = max(1, -(-n // DOC_BLOCK))
    # the other side's id is a filler that is not null: whole numbers stay whole in pandas
    docs = _vectors(corpus.select(F.lit(0).cast(q_type).alias("q"), F.col(c_id).alias("c"), F.lit(0).alias("kind"),
                                  tokens(F.coalesce(c_text, F.lit(""))).alias("w")), index, idf)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("c", "at", "x"), F.lit(blocks)).cast("int"))
    asked = _vectors(queries.select(F.col(q_id).alias("q"), F.lit(0).cast(c_type).alias("c"), F.lit(1).alias("kind"),
                                    tokens(F.coalesce(q_text, F.lit(""))).alias("w")), index, idf)
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, whole = None, [], None
        for batch in batches:
            for block, b in batch.groupby("block", sort=False):
                if block != key:
                    key, held, whole = block, [], None
                if (b["kind"] == 0).any():
                    held.append(b[b["kind"] == 0])
                b = b[b["kind"] == 1]
                if not len(b) or not held:
                    continue
                if whole is None:
                    whole = pd.concat(held)
                ids, matrix, found = b["q"].to_numpy(), _dense(b, len(idf)), []
                for at in range(0, len(whole), CHUNK):
                    part = whole.iloc[at:at + CHUNK]
                    sims = matrix @ _dense(part, len(idf)).T
                    rounded = sims.round(10)
                    least = np.partition(rounded, -min(k, len(part)), axis=1)[:, -min(k, len(part))]
                    i, j = np.nonzero((sims > 0) & (rounded >= least[:, None]))  # ties at the last place stay
                    found.append((ids[i], part["c"].to_numpy()[j], sims[i, j]))
                if found:
                    yield _best(*[np.concatenate(x) for x in zip(*found)], k)

    found = (docs.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind")
             .mapInPandas(score, f"q {q_type}, c {c_type}, similarity double"))
    return found.select(F.col("q").alias(q_id), F.col("c").alias(c_id), "similarity")


def best_of_any(queries: DataFrame, corpus: DataFrame, q_text: str, c_id: str, c_text: str, k: int,
                max_terms: int = MAX_TERMS, n_docs: int | None = None) -> DataFrame:
    """Candidates that hold the ``k`` documents most similar to any query, by the
    maximum over the queries (document, similarity), a row each.

    Documents that can reach the floor are dealt, once each, into blocks of
    about ``ANY_BLOCK`` vectors; the queries that can reach it follow them as a
    stream. In a block queries and documents meet under the terms that both keep
    (a pair is scored from the term on, which is its whole score at the first
    term it shares; elsewhere less, so the maximum counts), or all with all
    where that is less work. Only the best ``k`` of a block leave it. The driver
    holds numbers per term of the vocabulary (``max_terms``); no text, query or
    pair reaches it.
    """
    n = n_docs if n_docs is not None else corpus.count()
    # rarest terms first: a term's place is its order
    vocab = vocabulary(corpus, c_text, max_terms, n).select("term", "idf", "df").orderBy("df", "term").toPandas()
    index, idf = {t: i for i, t in enumerate(vocab["term"])}, vocab["idf"].to_numpy(np.float64)
    c_type = corpus.schema[c_id].dataType.simpleString()
    # the other side's id is a filler that is not null: whole numbers stay whole in pandas
    docs = _vectors(corpus.select(F.lit(0).alias("q"), F.col(c_id).alias("c"), F.lit(0).alias("kind"),
                                  tokens(F.coalesce(c_text, F.lit(""))).alias("w")), index, idf)
    docs = written(docs.where(F.size("at") > 0), "similar-documents")
    asked = _vectors(queries.select(F.lit(0).alias("q"), F.lit(0).cast(c_type).alias("c"), F.lit(1).alias("kind"),
                                    tokens(F.coalesce(q_text, F.lit(""))).alias("w")), index, idf)
    asked = written(asked.where(F.size("at") > 0).distinct(), "similar-queries")
    heavy = written(champions(docs), "similar-champions")  # at most CHAMPIONS rows a term
    top = heavy.groupBy("t").agg(F.max("w").alias("w")).toPandas()
    most = np.zeros(len(idf))
    most[top["t"]] = top["w"]

    terms = len(idf)
    floor = _floor(asked, heavy, most, k)

    def query_keeps(at, x, left):
        return np.minimum(np.cumsum((x * most[at])[::-1])[::-1], left) + SLACK >= floor

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        need = np.full(terms, np.inf)
        for b in batches:
            for at, x in zip(b["at"], b["x"]):
                left = _left_norm(x)
                kept = query_keeps(at, x, left)
                need[at[kept]] = np.minimum(need[at[kept]], floor / left[kept])
        t = np.flatnonzero(np.isfinite(need))
        yield pd.DataFrame({"t": t.astype(np.int32), "need": need[t]})

    # a document's norm from the term on that the least demanding query under it asks
    least = asked.select("at", "x").mapInPandas(needed, "t int, need double").groupBy("t").agg(F.min("need").alias("need")).toPandas()
    needs = np.full(terms, np.inf)
    needs[least["t"]] = least["need"]

    def doc_keeps(at, x, left):
        return left + SLACK >= needs[at]

    def reaching(keep):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b[np.array([keep(at, x, _left_norm(x)).any() for at, x in zip(b["at"], b["x"])], bool)]
        return run

    shape = f"c {c_type}, kind int, at array<int>, x array<double>"
    docs = written(docs.select("c", "kind", "at", "x").mapInPandas(reaching(doc_keeps), shape), "similar-reaching")
    asked = asked.select("c", "kind", "at", "x").mapInPandas(reaching(query_keeps), shape)
    left_docs, cores = docs.count(), corpus.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-left_docs // ANY_BLOCK), min(cores, -(-left_docs // CHUNK)))
    dealt = (docs.withColumn("block", F.pmod(F.xxhash64("c", "at", "x"), F.lit(blocks)).cast("int"))
             .unionByName(asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))))

    def under(b: pd.DataFrame, keep) -> dict[int, np.ndarray]:
        """The rows that keep each term."""
        kept = [at[keep(at, x, _left_norm(x))] for at, x in zip(b["at"], b["x"])]
        t, row = np.concatenate(kept), np.repeat(np.arange(len(b)), [len(x) for x in kept])
        order = np.argsort(t, kind="stable")
        places, starts = np.unique(t[order], return_index=True)
        return dict(zip(places.tolist(), np.split(row[order], starts[1:])))

    def meet(asked: pd.DataFrame, whole: pd.DataFrame, rows: np.ndarray | None, first: int, top: np.ndarray) -> None:
        matrix = _dense(asked, terms)[:, first:]
        rows = np.arange(len(whole)) if rows is None else rows
        for at in range(0, len(rows), CHUNK):
            some = rows[at:at + CHUNK]
            sims = matrix @ _dense(whole.iloc[some], terms)[:, first:].T
            top[some] = np.maximum(top[some], sims.max(axis=0, initial=0.0))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, whole, top = None, [], None, None

        def best_of_block() -> pd.DataFrame | None:
            if whole is None or not (top > 0).any():
                return None
            return _best(np.zeros((top > 0).sum(), np.int32), whole["c"].to_numpy()[top > 0], top[top > 0], k)

        for batch in batches:
            for block, b in batch.groupby("block", sort=False):
                if block != key:
                    last = best_of_block()
                    if last is not None:
                        yield last
                    key, held, whole, top = block, [], None, None
                if (b["kind"] == 0).any():
                    held.append(b[b["kind"] == 0])
                b = b[b["kind"] == 1]
                if not len(b) or not held:
                    continue
                if whole is None:
                    whole = pd.concat(held, ignore_index=True)
                    held, top, postings = [whole], np.zeros(len(whole)), under(whole, doc_keeps)
                met = [(t, q, postings[t]) for t, q in under(b, query_keeps).items() if t in postings]
                by_term = sum(len(q) * len(d) * (terms - t) + DENSE_ROW * (len(q) + len(d)) * terms for t, q, d in met)
                if by_term < (len(b) * len(whole) + DENSE_ROW * (len(b) + len(whole))) * terms:
                    for t, q, d in met:
                        meet(b.iloc[q], whole, d, t, top)
                else:
                    meet(b, whole, None, 0, top)
        last = best_of_block()
        if last is not None:
            yield last

    found = (dealt.repartition("block").sortWithinPartitions("block", "kind")
             .mapInPandas(score, f"q int, c {c_type}, similarity double"))
    return found.groupBy("c").agg(F.max("similarity").alias("similarity")).withColumnRenamed("c", c_id)


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, salt_col: Column | None = None,
                    salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group in ``order`` (a total order), without a
    window over a whole group: rows are first cut by a salt (a hash of the
    row when none is given) and ranked per (group, salt); only the best
    ``k`` per salt survive, so the final per-group window sees at most
    ``salt_buckets * k`` rows."""
    salt = salt_col if salt_col is not None else F.xxhash64(*df.columns)
    s = df.withColumn("_salt", F.pmod(salt, F.lit(salt_buckets)))
    s = s.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))) \
        .where(F.col("_r") <= k).drop("_r", "_salt")
    return s.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
        .where(F.col(rank_col) <= k)


def similar_docs(queries: DataFrame, corpus: DataFrame, q_id: str, q_text: str, c_id: str, c_text: str,
                 k: int = TOP_K, max_terms: int = MAX_TERMS, min_corpus: int = MIN_CORPUS) -> DataFrame:
    """M6: the ``k`` corpus documents most similar to any of the queries
    (score = max cosine over queries, > 0; ranked by the score rounded to
    10 places, then id, so equal texts rank by id), vocabulary and idf fitted on
    the corpus; empty when the corpus has fewer than ``min_corpus`` rows.
    Returns (doc, similarity, rank)."""
    n_docs = corpus.count()
    if n_docs < min_corpus:
        return corpus.sparkSession.createDataFrame([], f"{c_id} long, similarity double, rank int")
    best = best_of_any(queries, corpus, q_text, c_id, c_text, k, max_terms, n_docs)
    key = [F.round("similarity", 10).desc(), F.col(c_id).asc()]
    return best.orderBy(*key).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*key)).cast("int"))


def similar_per_query(queries: DataFrame, corpus: DataFrame, q_id: str, q_text: str, c_id: str, c_text: str,
                      k: int = TOP_K, max_terms: int = MAX_TERMS) -> DataFrame:
    """For every query its ``k`` most similar corpus documents (> 0)."""
    sims = best_matches(queries, corpus, q_id, q_text, c_id, c_text, k, max_terms)
    return top_k_per_group(sims, [q_id], [F.round("similarity", 10).desc(), F.col(c_id).asc()], k,
                           salt_col=F.xxhash64(F.col(c_id)))
