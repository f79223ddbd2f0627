"""SimHash near-duplicates against a plain all-pairs version."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hopgrid.llm import simhash
from hopgrid.llm.common import roots_of


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    ids = sorted(i for i, _ in rows)
    prints = {i: plain_fingerprint(t) for i, t in rows}
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return {i: (f"{prints[i]:016x}", label[i]) for i in ids}


def documents():
    rng = np.random.default_rng(5)
    words = [f"w{i}É" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "one"), (4, "ONE"), (5, "one two three four"), (6, "x y z " * 5000)]
    for base in range(12):
        text = list(rng.choice(words, 150))
        for k in range(6):
            copy = list(text)
            for _ in range(k):
                copy[rng.integers(150)] = "changed"
            rows.append((len(rows), " ".join(copy)))
    rows.append((len(rows), rows[20][1]))
    return rows


def test_against_all_pairs(spark):
    rows = documents()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame).collect()}
    assert got == plain_components(rows)
    kept = {r.doc_id for r in simhash.drop_near_duplicates(frame).collect()}
    assert kept == {c for _, c in got.values()}


def test_hot_bucket_is_shared(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**63))
    prints = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (300, 2))} | {1, 2, 3})
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.near_groups(frame).collect()}
    x = np.array(prints, np.uint64)
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 4)
    root = roots_of(len(prints), i, j)
    assert got == {p: int(root[k]) for k, p in enumerate(prints)}


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c d", 42)


@pytest.mark.parametrize("m", [3, 4, 5])
def test_thresholds_add_up(m):
    rng = np.random.default_rng(0)
    widths = [64 // m] * m
    values = [rng.integers(0, 1 << w, 50) for w in widths]
    expected = [simhash.ball_counts(rng.random(1 << min(w, 16)), w, 2) for w in widths]
    assert (simhash.allocate(values, widths, expected).astype(int) + 1).sum(1).tolist() == [5] * 50


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
