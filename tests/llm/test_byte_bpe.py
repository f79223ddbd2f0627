"""Ids against the tiktoken library and a plain lowest-rank search; the queue against sorting."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from hopgrid.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE = byte_bpe.RankBpe(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})
ODD = ["", " ", "  ", "a  b", " a", "a ", "it's Bob's", "x\n\n y", "x\n \n y", " x 　y", "tab\t\tz  \t q", "É é ß 漢字 🙂",
       "<|endoftext|>", "a" * 3000, "ab" * 4000, "1234 56", "\x1c x \x1c", "line\r\n next", "don 't", "_a _b", "́x", "\x00\x01", "=" * 999,
       "漢" * 2000, "https://example.org/" + "a1B2/" * 400]


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("text", [*ODD, " ".join(ODD * 3)])
def test_same_ids_as_library(text):
    packed = BPE.encode(text)
    assert ids(packed) == LIBRARY.encode_ordinary(text)
    assert BPE.decode(packed) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=300), st.text("abtheing \n", max_size=600), st.text("aab", max_size=400)))
def test_any_text(text):
    packed = BPE.encode(text)
    assert ids(packed) == LIBRARY.encode_ordinary(text)
    assert BPE.decode(packed) == text.encode("utf-8")


def plain_join(piece, ranks):
    tokens = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[t] for t in tokens]
        i = min(pairs)[1]
        tokens[i:i + 2] = [tokens[i] + tokens[i + 1]]


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.lists(st.binary(min_size=2, max_size=5), max_size=40, unique=True), st.randoms())
def test_any_vocabulary(piece, tokens, random):
    """Vocabularies whose joins may enable joins of a lower rank."""
    table = [bytes([b]) for b in range(256)] + tokens + [piece[i:i + 2] for i in range(0, len(piece) - 1)] + [piece[i:i + 3] for i in range(len(piece) - 2)]
    table = list(dict.fromkeys(table))
    random.shuffle(table)
    bpe = byte_bpe.RankBpe.__new__(byte_bpe.RankBpe)
    bpe.ranks = {t: i for i, t in enumerate(table)}
    bpe._queue = byte_bpe.RankQueue(len(table))
    assert bpe.join(piece) == plain_join(piece, bpe.ranks)
    bpe._pair_table()
    pieces = [piece, piece[1:] or piece, piece * 2, piece[::-1], piece]
    assert list(map(ids, bpe.join_all(pieces))) == [plain_join(p, bpe.ranks) for p in pieces]
    assert not bpe._queue.top and not any(bpe._queue.words) and not bpe._queue.buckets


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.tuples(st.integers(0, 60_000), st.integers(0, 50))), max_size=200))
def test_queue_gives_lowest_rank_then_leftmost_place(steps):
    queue, kept = byte_bpe.RankQueue(60_001), []
    for step in steps:
        if step:
            queue.push(*step)
            kept.append(step)
        else:
            want = min(kept, default=None)
            assert bool(queue.top) == bool(kept)
            if want:
                kept.remove(want)
                assert queue.pop() == want
    assert [queue.pop() for _ in range(len(kept))] == sorted(kept) and not queue.top


def test_rows(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate([None, *ODD, "word " * 50_000])] + [(5, ODD[3]), (5, ODD[3]), (None, "no id"), (None, None)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")
    for digests in (True, False):
        got = sorted(map(tuple, byte_bpe.encode_decode(frame, PATH, public_tokenizers.PATTERN, digests=digests).collect()), key=repr)
        want = []
        for i, t in rows:
            packed = np.array(LIBRARY.encode_ordinary(t or ""), "<u4").tobytes()
            pair = (packed, (t or "").encode())
            want.append((i, len(packed) // 4, *(hashlib.sha256(p).hexdigest() if digests else p for p in pair)))
        assert got == sorted(want, key=repr)
    for name, value in (("PIECES", 7), ("BLOCK", 60), ("BATCH", 3), ("SHORT", 4), ("WORDS_KEPT", 5)):
        monkeypatch.setattr(byte_bpe, name, value)
        packed = [b"".join(parts) for parts in byte_bpe.RankBpe(PATH, public_tokenizers.PATTERN).encode_all(ODD)]
        assert [ids(p) for p in packed] == [LIBRARY.encode_ordinary(t) for t in ODD]
    assert byte_bpe.encode_decode(frame.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_bytes_that_are_not_text(spark):
    frame = spark.range(1).selectExpr("id as doc_id", "cast(x'61FF62' as string) as text")
    row = byte_bpe.encode_decode(frame, PATH, public_tokenizers.PATTERN).first()
    assert bytes(row.decoded).decode() == "a�b"
