"""Token operators against the tokenizers library and exact round trips."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidings.llm import packing, pfor, tokencount, vocab
from tidings.llm.vocab import SPACE, Encoder, path_of

ALPHABET = ("\t\n\x0b\x0c\r \x85\xa0  　\x1c\x1f᠎​﻿" + "   \n\n ab'sTt9ééΣσSßİहि"
            "漢字\U0001f600.,!--'")


def texts(n=4000, seed=1):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return made + ["a <|endoftext|> b", "x  <|endoftext|>y <|startoftext|>", "", "'s 't foo's we'll", "  \n foo \n\n  bar  ",
                   "word" * 5000, "tokens and words " * 3000]


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_memoised_ids_equal_the_library(name, words):
    e = Encoder(path_of(name), words)
    whole = texts() + [None]
    want = [np.array(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch([t or "" for t in whole], add_special_tokens=False)]
    assert e.encode(whole) == want
    assert e.encode(whole) == want  # from the memo
    assert len(SPACE) > 10


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_a_batch_encodes_each_distinct_chunk_once(name, words, monkeypatch):
    """However little the memo holds, and with marks behind the words."""
    monkeypatch.setitem(vocab.MEMO_BYTES, words, 0)
    e = Encoder(path_of(name), words)
    calls = []

    class Model:
        def tokenize(self, text, model=e.model):
            calls.append(text)
            return model.tokenize(text)
    e.model = Model()
    made = [f"go {a}{m} {b}{m}" for m in ("", ".", "?!", "***") for a in ("alpha", "\xe9t\xe9") for b in ("beta", "Gamma")] * 3
    got = e.encode(made)
    assert sorted(set(calls)) == sorted(calls)
    assert got == [np.array(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch(made, add_special_tokens=False)]


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_cuts_of_marks_and_white_space(name, words):
    e = Encoder(path_of(name), words)
    rnd = random.Random(4)
    parts = ["a", "Zo", "\xe9", "\xd7", "\xf7", "\xdf", "\u2026", "\u0301", "\u0338", "'", "'s", ",", "=", "_", "...", "7", " ", "  ", "\n", "\t",
             "\x0b", "\x0c", "\x85", "\xa0", "\u2028", "\x1c", "<|endoftext|>", "<", "\u0142", "\u6f22", "\0"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(20000)]
    want = [np.array(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch(made, add_special_tokens=False)]
    assert e.encode(made) == want
    whole = pa.array([None, "x,", *made])
    assert e.encode(whole.slice(2)) == want and e.encode(whole.slice(0, 1)) == [b""] and e.encode(whole.slice(0, 0)) == []


def test_counts_equal_the_library():
    e = Encoder(path_of("byte_bpe_50k.json"), words=False)
    counter = tokencount.MergeCounter(path_of("byte_bpe_50k.json"))
    for t, ids in zip(texts(), e.encode(texts())):
        assert counter.count(t) == len(ids) // 4, repr(t)
    assert counter.count(None) == 0


def test_count_tokens_edges(spark):
    rows = [(1, None, 9), (2, "", 9), (None, "hé llo", 9), (2, "", 9), (3, "x " * 2000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = sorted((tuple(r) for r in tokencount.count_tokens(df).collect()), key=str)
    assert (1, 0, 0, False) in got and got.count((2, 0, 0, False)) == 2
    assert next(r for r in got if r[0] is None)[1] == 7
    assert next(r for r in got if r[0] == 3)[3] is True
    assert tokencount.count_tokens(df.limit(0)).count() == 0


@pytest.mark.parametrize("values", [
    [], [7], list(range(512)), [5] * 1500, [0, 4294967295] * 700, [1] * 500 + [60000] * 13 + [2] * 900])
def test_blocks_round_trip(values):
    ids = np.array(values, "u4")
    frame = pfor.encode_frame([3, None], [ids.astype("<u4").tobytes(), b""], 11)
    doc_ids, counts, back, first = pfor.decode_frame(memoryview(frame))
    assert doc_ids == [3, None] and list(counts) == [len(values), 0] and first == 11
    assert (back == ids).all()


def test_random_blocks_round_trip():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(0, 3000))
        ids = rng.integers(0, 1 << int(rng.integers(1, 33)), n).astype("u4")
        ids[rng.random(n) < 0.03] = rng.integers(0, 1 << 32)
        frame = pfor.encode_frame([0], [ids.astype("<u4").tobytes()], 0)
        assert (pfor.decode_frame(memoryview(frame))[2] == ids).all()


def test_common_ids_take_less_than_raw():
    ids = np.random.default_rng(1).zipf(1.3, 100_000).clip(max=49000).astype("<u4")
    assert len(pfor.encode_frame([0], [ids.tobytes()], 0)) < 0.6 * ids.nbytes


def test_shards_give_every_document(spark):
    rnd = random.Random(5)
    rows = [(i * 3 - 50, " ".join(rnd.choice(["alpha", "beta", "x", "\n"]) for _ in range(rnd.randint(0, 60))), 1) for i in range(300)]
    rows += [(7, None, 1), (7, None, 1), (None, "no id", 1), (8, "", 1), (9, "long " * 20000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    got = sorted(pfor.token_shards(df).collect(), key=lambda r: r.start)
    e = Encoder(path_of("word_bpe_49k.json"), words=True)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [x + (2).to_bytes(4, "little") for x in e.encode([r[1] for r in order])]
    assert [r.doc_id for r in got] == [r[0] for r in order]
    assert [r.n_tokens for r in got] == [len(x) // 4 for x in ids]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(x) for x in ids]
    assert [r.start for r in got] == list(np.cumsum([0] + [len(x) // 4 for x in ids[:-1]]))
    assert pfor.token_shards(df.limit(0)).count() == 0


def test_best_fit_against_plain_search():
    rnd = random.Random(9)
    for open_bins in (1, 3, 50):
        fit, open_, seen = packing.BestFit(100, open_bins), {}, 0
        for _ in range(600):
            n = rnd.randint(1, 100)
            seq, at = fit.place(n)
            room = [f for f in open_.values() if f >= n]
            if room:  # the fullest that holds it
                assert open_[seq] == min(room) and at == 100 - open_[seq]
            else:
                if len(open_) >= open_bins:
                    # the fullest closed; which one of equals does not matter
                    fullest = min(open_.values())
                    gone = [k for k, f in open_.items() if f == fullest]
                    free_now = {b for stack in fit.by_free for b in stack} | {seq}
                    del open_[next(k for k in gone if k not in free_now)]
                assert at == 0 and seq == seen
                seen, open_[seq] = seen + 1, 100
            open_[seq] -= n
            if not open_[seq]:
                del open_[seq]
            assert fit.open == len(open_) <= open_bins


def test_large_batches_are_cut_into_slices():
    """However many rows the session puts into a batch."""
    made = pa.array([None, "", *["word " * 20] * 50, "long " * 3000, None, "x"])
    parts = list(vocab.slices(pa.RecordBatch.from_arrays([made], ["text"]), most=1000))
    assert [t for p in parts for t in p.column("text").to_pylist()] == made.to_pylist()
    assert all(sum(len(t or "") for t in p.column("text").to_pylist()[:-1]) <= 1000 for p in parts)
    assert list(vocab.slices(pa.RecordBatch.from_arrays([made[:0]], ["text"]))) == []


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]


def test_packing_whole_documents(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["one", "two", "été"]) for _ in range(rnd.randint(0, 300))), "x") for i in range(250)]
    rows += [(1, None, "x"), (None, "a b", "x"), (3, rows[3][1], "x"), (3, rows[3][1], "x"), (900, "tok " * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(4)
    got = packing.pack_documents(df, pieces_per_bucket=100).collect()
    e = Encoder(path_of("byte_bpe_50k.json"), words=False)
    want = []
    for d, t, _ in rows:
        ids = e.encode([t])[0] + (2).to_bytes(4, "little")
        want += [(d, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for k, (s, n) in enumerate(packing.cut(len(ids) // 4, 1024))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(by) <= 1.1 * (-(-total // 1024)) + 3
    again = {(r.doc_id, r.piece, r.start, r.length, r.sequence_id, r.offset) for r in packing.pack_documents(df, pieces_per_bucket=100).collect()}
    assert again == {(r.doc_id, r.piece, r.start, r.length, r.sequence_id, r.offset) for r in got}
    assert packing.pack_documents(df.limit(0)).count() == 0
