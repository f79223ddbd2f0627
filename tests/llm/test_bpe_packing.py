"""Ids against the tokenizers library; packing against plain best-fit decreasing."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from hopgrid.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BPE = bpe.ByteBpe(PATH)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


ODD = ["", " ", "  ", "a  b", " a", "a ", "it's Bob's", "x\n\n y", "x\n \n y", " x 　y", "tab\t\tz  \t q", "É é ß 漢字 🙂",
       "<|endoftext|> a <|endoftext|>", "a" * 3000, "1234 56", "\x1c x \x1c", "line\r\n next", "don 't", "_a _b", " ́x"]


@pytest.mark.parametrize("text", ODD + [" ".join(ODD * 40), "word " * 5000])
def test_same_ids_as_library(text):
    expect = np.array(ids(text), "<u4").tobytes()
    assert BPE.encode(text) == expect
    assert BPE.encode_by_chunks(text) == expect
    assert BPE.decode(expect) == LIBRARY.decode(ids(text), skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "'s", "é", "1", "\t", ".", " x", " ", "the ", "漢", "_"]), max_size=900))
def test_any_mixture(parts):
    text = "".join(parts)
    assert BPE.encode_by_chunks(text) == np.array(ids(text), "<u4").tobytes()


def test_query_columns(spark):
    rows = [(i, t) for i, t in enumerate([None, *ODD])] + [(5, ODD[3])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(frame, PATH, digests=True).collect())
    want = sorted((i, len(ids(t or "")), hashlib.sha256(np.array(ids(t or ""), "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert got == want


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_plan_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    steps = sorted(packing.plan(counts, 32))
    bins = defaultdict(list)
    for i, (n, rank, first, offset) in enumerate(steps):
        last = steps[i + 1][1] if i + 1 < len(steps) and steps[i + 1][0] == n else counts[n]
        for k in range(last - rank):
            bins[first + k].append((offset, n))
    assert sum(map(len, bins.values())) == len(lengths)
    for content in bins.values():
        content.sort()
        assert all(o == sum(n for _, n in content[:i]) for i, (o, _) in enumerate(content))
    assert sorted(32 - sum(n for _, n in c) for c in bins.values()) == plain_best_fit(lengths, 32)


def test_pack(spark):
    rng = np.random.default_rng(2)
    rows = [(0, None), (1, ""), (2, "word " * 5000), (None, "x")] + [(k, "word and more " * int(rng.integers(1, 200))) for k in range(3, 60)]
    rows += [(k, rows[10][1]) for k in range(60, 90)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    got = packing.pack(frame, PATH, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and 0 < r.length <= 1024
    for doc, text in rows:
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        assert b"".join(r.ids for r in parts) == np.array([*ids(text or ""), 2], "<u4").tobytes()
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert all(r.length == 1024 for r in parts[1:])
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert sum(r.length for r in parts) <= 1024
    assert len(by_sequence) == len(plain_best_fit([r.length for r in got], 1024))
    assert packing.pack(frame.where("false"), PATH).count() == 0
