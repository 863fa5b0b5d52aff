"""Language identification with hyperdimensional profiles.

Each letter has a fixed random vector of +1 and -1. An n-gram's vector binds
its letters' vectors, each permuted (rolled) by its place, by element-wise
product. A text's vector bundles (adds) the vectors of its n-grams, and a
language's prototype bundles those of all its training texts. A text gets the
language whose prototype has the highest cosine with its vector; the score is
that cosine, at least 0.

Letters are lower-cased; a run of anything else is one blank. a-z have a
symbol each, other letters share the remaining symbols by code point, so the
tables are of fixed size for any script.

Training reads all training rows: each task bundles what it reads and returns
one vector per language; Spark adds them per (language, dimension). The
driver holds languages x dimensions numbers, which does not grow with the
corpus. Prediction is one pass over the documents without a shuffle.

A text is accepted as one of the languages by its score for its size. Its size
is the number of n-grams that it would have if none were repeated: (sum of
counts) squared / sum of squared counts. The score of a language's own texts
grows as the root of their size, that of unrelated texts stays within chance
(about 1 / sqrt(DIMS)). So (score + ``CHANCE``) / sqrt(size) is compared with
``FLOOR`` times a low quantile of the same over the language's learned texts:
few n-grams prove little, and the shorter a text, the more passes.

Null texts and texts without a letter are ``und`` with score 0. So is every
text when no training row has a language. Ties go to the language that sorts
first. Rows are judged one by one, so repeated rows and ids do not matter; an
empty table gives an empty result. Very long texts are bundled in slices. Other
columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.names import unused

UNKNOWN = "und"
DIMS = 512
NGRAM = 3
SYMBOLS = 128
SEED = 20
QUANTILE = 0.05  # of (score + CHANCE) / sqrt(size) among the learned texts of a language
FLOOR = 0.6  # of that quantile
LEAST = 0.02  # the same, asked where no floor was learned
CHANCE = 2.0 / DIMS ** 0.5  # two deviations of the score of unrelated texts
BLOCK = 1024  # n-grams expanded at once
BATCH_CHARS = 1 << 18


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: 0 for anything but letters."""
    table = np.zeros(0x110000, np.uint8)
    letters = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()])
    table[letters] = 27 + letters % (SYMBOLS - 27)
    table[97:123] = np.arange(1, 27)
    return table


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    """(place, symbol, dimension): place k's vectors are rolled k times."""
    base = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMS)).astype(np.int8) * 2 - 1
    return np.stack([np.roll(base, NGRAM - 1 - k, axis=1) for k in range(NGRAM)])


def bundle(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the n-grams' vectors, each ``count`` times."""
    letters = letter_vectors()
    total = np.zeros(DIMS, np.float64)
    for i in range(0, len(grams), BLOCK):
        g = grams[i:i + BLOCK]
        v = letters[NGRAM - 1][g % SYMBOLS]
        for k in range(NGRAM - 2, -1, -1):
            g = g // SYMBOLS
            v = v * letters[k][g % SYMBOLS]
        total += counts[i:i + BLOCK].astype(np.float32) @ v.astype(np.float32)
    return total


def _ngrams(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, n-gram, count) over texts with a label each, sorted by label."""
    low = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    sym = symbol_table()[points].astype(np.int64)
    text = np.repeat(np.arange(len(low)), [len(t) for t in low])
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0) | (text[1:] != text[:-1])
    sym, text = sym[keep], text[keep]
    n = max(0, len(sym) - NGRAM + 1)
    gram = np.zeros(n, np.int64)
    for k in range(NGRAM):
        gram = gram * SYMBOLS + sym[k:k + n]
    same = text[:n] == text[NGRAM - 1:]
    space = SYMBOLS ** NGRAM
    keys, counts = np.unique(labels[text[:n][same]].astype(np.int64) * space + gram[same], return_counts=True)
    return keys // space, keys % space, counts


def _slices(texts) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded total length; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    yield start, len(texts)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, np.ndarray]]:
    """Prototypes (unit vectors) of the languages of ``docs``, all its rows
    with a text and a language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            codes, langs = pd.factorize(b["lang"])
            texts = b["text"].tolist()
            for i, j in _slices(texts):
                label, gram, count = _ngrams(texts[i:j], codes[i:j])
                for k in np.unique(label):
                    at = label == k
                    sums[langs[k]] = sums.get(langs[k], 0) + bundle(gram[at], count[at])
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": list(sums.values())})

    parts = rows.mapInPandas(run, "lang string, vector array<double>")
    summed = (parts.select("lang", F.posexplode("vector").alias("dim", "value"))
              .groupBy("lang", "dim").agg(F.sum("value").alias("value"))  # whole numbers: exact in any order
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
              .select("lang", F.col("v.value").alias("v")))
    found = sorted((r["lang"], np.array(r["v"])) for r in summed.collect())  # languages x DIMS numbers
    return [(lang, v / np.linalg.norm(v)) for lang, v in found if v.any()]


def identify(docs: DataFrame, prototypes: list[tuple[str, np.ndarray]], text_col: str = "text",
             lang_col: str = "lang_pred", score_col: str = "score", size_col: str | None = None) -> DataFrame:
    """Adds the predicted language and its score, and the text's size if
    ``size_col`` is given; input columns of those names are replaced."""
    langs = [lang for lang, _ in prototypes]
    matrix = np.stack([v for _, v in prototypes]) if prototypes else np.zeros((0, DIMS))

    def judge(texts: list[str | None]) -> pd.DataFrame:
        whole = [t or "" for t in texts]
        out = [(UNKNOWN, 0.0, 0.0)] * len(whole)
        for i, j in _slices(whole):
            label, gram, count = _ngrams(whole[i:j], np.arange(j - i))
            ends = np.searchsorted(label, np.arange(j - i + 1))
            for d in range(j - i if langs else 0):
                at = slice(ends[d], ends[d + 1])
                if gram[at].any():  # 0 is the n-gram of blanks
                    v = bundle(gram[at], count[at])
                    cos = matrix @ v / max(np.linalg.norm(v), 1e-12)
                    k = int(np.argmax(cos))
                    n = count[at].astype(np.float64)
                    out[i + d] = (langs[k], float(min(1.0, max(0.0, cos[k]))), float(n.sum() ** 2 / (n * n).sum()))
        return pd.DataFrame(out, columns=["lang", "score", "size"])

    @F.pandas_udf("lang string, score double, size double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield judge(texts.tolist())

    judged, = unused([*docs.columns, lang_col, score_col, size_col or ""], "judged")
    added = {lang_col: F.col(judged)["lang"], score_col: F.col(judged)["score"]}
    if size_col:
        added[size_col] = F.col(judged)["size"]
    return docs.withColumn(judged, predict(F.col(text_col))).drop(*added).withColumns(added).drop(judged)


def held_out(id_col: str = "doc_id"):
    """The documents that are never learned from: crc32 of the id, as text,
    leaves 2 when divided by 4 (a null id is learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def floors(docs: DataFrame, prototypes: list[tuple[str, np.ndarray]], text_col: str = "text",
           lang_col: str = "lang") -> dict[str, float]:
    """The (score + CHANCE) / sqrt(size) asked of each language, from all learned texts
    that are recognised as their own language; one number per language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    found = identify(rows, prototypes, "text", "_lang", "_score", "_size").where("_lang = lang AND _size > 0")
    low = found.groupBy("lang").agg(F.percentile_approx((F.col("_score") + CHANCE) / F.sqrt("_size"), QUANTILE).alias("low")).collect()
    return {r["lang"]: FLOOR * r["low"] for r in low}


def accepted(docs: DataFrame, prototypes: list[tuple[str, np.ndarray]], text_col: str = "text",
             least: dict[str, float] | None = None) -> DataFrame:
    """The documents in one of the languages: with a letter, and as close to a
    prototype as their size lets expect of the language's texts. ``least`` has
    the floors; a language without one asks ``LEAST``."""
    guess, score, size = unused(docs.columns, "lang_pred", "score", "size")
    found = identify(docs, prototypes, text_col, guess, score, size)
    floor = F.lit(LEAST)
    if least:
        items = sorted(least.items())
        floor = F.when(F.col(guess) == items[0][0], items[0][1])
        for lang, value in items[1:]:
            floor = floor.when(F.col(guess) == lang, value)
        floor = floor.otherwise(LEAST)
    clear = F.col(score) >= floor * F.sqrt(size) - CHANCE
    return found.where((F.col(guess) != UNKNOWN) & clear).select(*docs.columns)
