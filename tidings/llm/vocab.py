"""Tokenizer access shared by the token operators: ids by the tokenizers
library, looked up once per distinct chunk of a batch.

A byte-pair tokenizer never merges across a pre-token boundary, and both
vocabularies used here always start a new pre-token where a run of white
space begins and between a word and the marks after it. The bytes of a
batch are therefore cut where ASCII white space begins; a chunk is a run of it and
what stands up to the next one. Arrow numbers the distinct chunks of the batch, each
is encoded once, and the ids of all texts are gathered by those numbers. A plain
word is one pre-token, so the library's model gets it directly; other chunks take
the library's whole way. Texts that hold a special string go to it whole. Where
white space counts, texts with more than ASCII's are cut by a pattern.

Chunks stay in a memo of the worker. It is bounded by its bytes: long
chunks are not kept, and when it is full it becomes the older of two
generations, from which chunks that are used again come back, so the words of
the language stay and those seen once go.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as Unicode has it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin-1 letters: all of them are letters to the vocabularies, too.
LETTER = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
#: A word before white space or a common stop, the stops after it, or whatever
#: stands up to the next white space; white space itself.
BYTE_CHUNKS = (f" ?[{LETTER}]+(?=[ \n.,;:!?]|\\Z)|[.,;:!?]+(?=[ \n]|\\Z)| ?[^{SPACE}]+"
               f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Single bytes that are white space.
BLANKS = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
#: White space of more than one byte.
WIDE_SPACE = SPACE[6:]
#: ASCII marks: to both vocabularies neither letters nor digits.
MARKS = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum()])
LETTERS = np.isin(np.arange(256), [c for c in range(128) if chr(c).isalpha()])
#: A word of Latin-1 letters: all of them are letters to the vocabularies, too.
PLAIN = rb"(?:[A-Za-z]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"

#: Bytes of one generation of the memo (dictionary, chunks and ids): of the
#: vocabulary that drops white space, and of the other, which the pipeline holds
#: beside what its earlier stages have left.
MEMO_BYTES = {True: 96 << 20, False: 24 << 20}
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
MEMO_CHARS = 20
#: What an entry takes besides its text and ids: two objects, a place in the dictionary.
ENTRY_BYTES = 190


#: Bytes of text encoded at once: the arrays of a slice take many times its bytes.
SLICE_BYTES = 2 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in order, in runs of about ``most`` bytes of text,
    however many rows the session puts into a batch. A longer text is in one run."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("i8")
    run = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(size)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def path_of(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    itself where Latin-1 prints it, else the next free one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class _Memo(dict):
    """Ids of chunks; what is missing is taken from the older generation or
    computed, and kept if it is short."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.older, self.size = compute, most, {}, 0

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.compute(chunk)
        if len(chunk) <= MEMO_CHARS:
            self[chunk] = ids
            self.size += ENTRY_BYTES + len(chunk) + len(ids)
            if self.size > self.most:  # a full generation becomes the older one
                self.older, self.size = dict(self), 0
                self.clear()
        return ids


class Encoder:
    """Encode texts to little-endian unsigned 32-bit ids, as bytes."""

    _shared: dict = {}

    def __init__(self, path: str, words: bool):
        """``words``: the vocabulary drops white space."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = words
        self.pattern = re.compile(BYTE_CHUNKS).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = '"Lowercase"' in self.tokenizer.to_str()
        self.plain = re.compile(PLAIN).fullmatch
        self.symbols = "".join(byte_symbols())
        self.memo = _Memo(self._chunk, MEMO_BYTES[words])

    @classmethod
    def shared(cls, path: str, words: bool) -> Encoder:
        """The worker process keeps one encoder for each vocabulary."""
        if (path, words) not in cls._shared:
            cls._shared[path, words] = cls(path, words)
        return cls._shared[path, words]

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if LITTLE else struct.pack(f"<{len(ids)}I", *ids)

    def _library(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: bytes) -> bytes:
        word = chunk[1:] if chunk.startswith(b" ") else chunk
        if word.isalpha():  # of ASCII letters
            text = (word.lower() if self.lower else word).decode()
        elif self.plain(word):
            text = charmap_decode(word.decode().lower().encode() if self.lower else word, "strict", self.symbols)[0]
        else:
            return self._library(chunk.decode())
        if not self.words and len(word) < len(chunk):
            text = self.symbols[32] + text
        return self.pack([t.id for t in self.model.tokenize(text)])  # one pre-token: the model's input

    def _alone(self, text: str) -> bytes:
        """A text that is not to be cut at ASCII white space alone."""
        if any(s in text for s in self.special):
            return self._library(text)
        return b"".join([self.memo[c.encode()] for c in self.pattern(text)])

    @staticmethod
    def _cuts(text: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """Where chunks begin: at ASCII white space behind anything else, and
        at marks between a letter and white space or the text's end."""
        begins = np.zeros(len(text), bool)
        blank, mark = BLANKS[text], MARKS[text]
        begins[1:] = blank[1:] & ~blank[:-1]
        at = np.flatnonzero(mark[1:] & ~mark[:-1] & ~blank[:-1]) + 1
        before, lead = text[at - 1], text[np.maximum(at - 2, 0)]
        latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        at = at[LETTERS[before] | latin]
        stop = np.append(blank, True) | opens  # here a text's or chunk's marks are over
        over = np.flatnonzero(np.append(~mark, True) | opens)
        begins[at[stop[over[np.searchsorted(over, at, "right")]]]] = True
        return begins

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and end); null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.empty(0, "<u4"), np.zeros(1, "i8")
        apart = np.zeros(len(texts), bool)
        for s in self.special:
            apart |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not self.words:
            apart |= pc.match_substring_regex(texts, f"[{WIDE_SPACE}]").to_numpy(zero_copy_only=False)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, "i8", len(texts) + 1, 8 * texts.offset)
        first, last = int(ends[0]), int(ends[-1])
        bounds = np.zeros(len(texts) + 1, "i8")
        if first == last:
            return np.empty(0, "<u4"), bounds
        text = np.frombuffer(data, "u1", last)[first:]
        opens = np.zeros(last - first + 1, bool)  # where texts begin, and the end
        opens[ends - first] = True
        begins = self._cuts(text, opens)
        for k in np.flatnonzero(apart):  # one chunk each
            begins[ends[k] - first:ends[k + 1] - first] = False
        begins |= opens[:-1]
        starts = np.append(np.flatnonzero(begins) + first, last).astype("i8", copy=False)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), data]).dictionary_encode()
        found = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = chunks.indices.to_numpy()
        special = {int(which[np.searchsorted(starts, ends[k])]) for k in np.flatnonzero(apart)}
        memo = self.memo
        each = [self._alone(c.decode()) if j in special else memo[c] for j, c in enumerate(found)] if special else \
            [memo[c] for c in found]
        known = np.frombuffer(b"".join(each), "<u4")
        size = np.fromiter(map(len, each), "i8", len(each)) // 4
        at, n = (np.cumsum(size) - size)[which], size[which]
        upto = np.cumsum(n)
        out = known[np.repeat(at - (upto - n), n) + np.arange(upto[-1])]
        bounds = np.concatenate(([0], upto))[np.searchsorted(starts, ends)]
        return out, bounds

    def encode(self, texts) -> list[bytes]:
        """Ids of each text; null counts as empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.large_string())
        ids, bounds = self.ids(texts)
        raw, bounds = memoryview(ids.tobytes()), (4 * bounds).tolist()
        return [bytes(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
