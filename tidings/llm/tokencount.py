"""Token counts by byte-pair merging with a heap and a linked list.

The count of a text is its initial symbols minus the merges that byte-pair
encoding makes; identifiers are never produced. A pre-token's bytes form a
doubly linked list. A heap holds its adjacent pairs by merge rank, then
position; popping the lowest rank merges that pair, links the neighbours and
pushes the two new pairs. Stale entries are recognised by the symbols that
they were pushed with. Pre-tokens are cut by the vocabulary's own pattern;
counts of short white-space separated chunks are memoised per worker, in a
bounded table. Special strings count one token each, as the library's
default has it, and cut the text.

Null text counts as empty: 0 bytes, 0 tokens. Texts of any length work; one
without white space is cut by the pattern only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.vocab import BYTE_CHUNKS, SPACE, byte_symbols, path_of

#: Fixed value: the pre-token pattern of byte-level vocabularies.
PRETOKENS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
MEMO_ENTRIES = 1_000_000
MEMO_CHARS = 24


class MergeCounter:
    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(spec["model"]["merges"])}
        self.symbols = byte_symbols()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pretokens = regex.compile(PRETOKENS).findall
        self.chunks = re.compile(BYTE_CHUNKS).findall
        self.memo: dict[str, int] = {}

    def merged(self, pretoken: str) -> int:
        """Tokens of one pre-token."""
        sym = [self.symbols[b] for b in pretoken.encode("utf-8")]
        count = len(sym)
        rank = self.rank
        heap = [(rank[p], i, p) for i, p in enumerate(zip(sym, sym[1:])) if p in rank]
        if not heap:
            return count
        heapify(heap)
        right = list(range(1, count + 1))
        left = list(range(-1, count - 1))
        end = count
        while heap:
            _, i, (a, b) = heappop(heap)
            j = right[i]
            if sym[i] != a or j >= end or sym[j] != b:
                continue  # one of the two has been merged since
            sym[i], sym[j] = a + b, None
            count -= 1
            k = right[i] = right[j]
            if k < end:
                left[k] = i
                p = (sym[i], sym[k])
                if p in rank:
                    heappush(heap, (rank[p], i, p))
            h = left[i]
            if h >= 0:
                p = (sym[h], sym[i])
                if p in rank:
                    heappush(heap, (rank[p], h, p))
        return count

    def _chunk(self, chunk: str) -> int:
        n = sum(map(self.merged, self.pretokens(chunk)))
        if len(chunk) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[chunk] = n
        return n

    def _plain(self, text: str) -> int:
        memo, n = self.memo, 0
        for c in self.chunks(text):
            m = memo.get(c)
            n += self._chunk(c) if m is None else m
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.special:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_count(text: Column, vocabulary: str = "byte_bpe_50k.json") -> Column:
    """Number of tokens of a text column."""
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path_of(vocabulary))
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int64")
    return count(text)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024,
                 vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                        token_count(text, vocabulary).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
