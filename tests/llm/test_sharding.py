"""Shards against a sort of all keys."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np

from hopgrid.llm import sharding


def test_shards(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(rng.integers(0, 400)) + str(i)) for i in range(600)] + [(i, "copy of one text") for i in range(600, 1000)]
    rows += [(1000, None), (1001, ""), (None, "no id"), (1002, "y" * 5000), (1003, "again"), (1003, "again")]
    frame = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, size int").repartition(5)
    got = sharding.shards(frame, 8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len(t or "") + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert set(slots) <= set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Boundaries miss their targets by the slack or by half of the document that lies across.
    total = sum(sizes.values())
    edges = np.cumsum([sizes[i] for i in range(8)])[:-1]
    miss = np.abs(edges - total * np.arange(1, 8) / 8)
    assert (miss <= 5016 / 2 + total / len(rows)).all() and np.sort(miss)[-2] <= 420
    assert sum(len({r.shard for r in got if r.text_crc32 == zlib.crc32(t)}) - 1 for t in {(t or "").encode() for _, t in rows}) <= 7
    sharding.write_shards(frame, str(tmp_path / "out"), 8)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert sharding.shards(frame.where("false"), 8).count() == 0


def test_one_text_is_split_by_id(spark):
    frame = spark.createDataFrame([(i * 7, "same") for i in range(800)], "doc_id long, text string")
    sizes = Counter(r.shard for r in sharding.shards(frame, 40).collect())
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2
