"""Exact dedup against a dictionary, the directory's rule, and a plan without Python."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hopgrid.llm import exact_dedup
from hopgrid.llm.queries import QUERIES

ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (9, " a b c"), (4, None), (7, ""), (2, " "), (8, "\n\t"), (11, "a b"), (12, "a b"),
    (None, "a b c"), (None, "only without an id"), (20, "x" * 200_000), (21, "x" * 200_000), (22, "x" * 199_999 + "y"),
    (30, "twice"), (30, "twice"), (31, "A b c"),
]


def normal(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out, taken = [], set()
    for doc_id, text in rows:
        ids = groups[normal(text)]
        keep = min((i for i in ids if i is not None), default=None)
        kept = doc_id == keep and normal(text) not in taken  # exactly one row of a group
        if kept:
            taken.add(normal(text))
        out.append((doc_id, keep, len(ids), kept,
                    hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame) -> list[tuple]:
    return sorted(map(tuple, frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_same_as_a_dictionary(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(exact_dedup.exact_duplicates(docs)) == expected(ROWS)


def test_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(*r, 1, "k", 2) for r in ROWS], "doc_id long, text string, keep_id int, key string, bucket int")
    assert found(exact_dedup.exact_duplicates(docs)) == expected(ROWS)
    stays = exact_dedup.drop_exact_duplicates(docs)
    assert stays.columns == docs.columns
    assert sorted((r.doc_id for r in stays.collect()), key=repr) == sorted((r[0] for r in expected(ROWS) if r[3]), key=repr)
    none = docs.limit(0)
    assert exact_dedup.exact_duplicates(none).count() == 0 and exact_dedup.drop_exact_duplicates(none).count() == 0


@pytest.mark.parametrize("capacity", [1, 3, 50])
def test_directory_splits_overfull_buckets(spark, capacity):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    entries = exact_dedup.map_entries(docs)
    keys = [r.key % (1 << 64) for r in entries.select("key").collect()]
    held = lambda prefix, depth: sum(k >> (64 - depth) == prefix if depth else True for k in keys)
    for slot in exact_dedup.directory(entries, capacity).collect():
        shift = exact_dedup.MAX_DEPTH - slot.depth
        assert slot.bucket == slot.slot >> shift << shift
        assert held(slot.slot >> shift, slot.depth) <= capacity or slot.depth == exact_dedup.MAX_DEPTH
        assert not slot.depth or held(slot.slot >> shift >> 1, slot.depth - 1) > capacity  # no split that was not needed


def test_equal_keys_are_chained_and_compared(spark, monkeypatch):
    """Three keys for all texts: only the bytes tell them apart."""
    monkeypatch.setattr(exact_dedup, "key_of", lambda norm: F.pmod(F.xxhash64(norm), F.lit(3)))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    assert found(exact_dedup.exact_duplicates(docs)) == expected(ROWS)
    slots = exact_dedup.directory(exact_dedup.hash_probes(docs))
    index = exact_dedup.build_index(exact_dedup.map_entries(docs), slots).collect()
    assert len(index) == len({normal(t) for _, t in ROWS}) and max(r.chain for r in index) > 0
    assert len({(r.bucket, r.key, r.chain) for r in index}) == len(index)
    stays = exact_dedup.drop_exact_duplicates(docs).collect()
    assert sorted((r.doc_id for r in stays), key=repr) == sorted((r[0] for r in expected(ROWS) if r[3]), key=repr)


def test_owners_finish_groups_and_the_directory_places_them(spark, monkeypatch):
    """Copies reach the owner from several parts; a directory that misses a bucket loses its rows."""
    rows = [(i, "the same" if i % 3 == 0 else f"text {i % 50}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    entries = exact_dedup.map_entries(docs)
    assert entries.where("norm = 'the same'").count() > 1
    slots = exact_dedup.directory(entries, 4).collect()
    assert len({s.bucket for s in slots}) > 8
    kind = "slot int, depth int, bucket int"
    whole = exact_dedup.build_index(entries, spark.createDataFrame(slots, kind))
    assert {(r.keep_id, r.group_size) for r in whole.collect()} == {(r[1], r[2]) for r in expected(rows)}
    gone = min(slots, key=lambda s: s.depth).bucket
    part = exact_dedup.build_index(entries, spark.createDataFrame([s for s in slots if s.bucket != gone], kind))
    assert part.count() < whole.count()
    # The third of all rows is broadcast, the rest is looked up.
    monkeypatch.setattr(exact_dedup, "HOT_ENTRIES", 4)
    assert found(exact_dedup.exact_duplicates(docs)) == expected(rows)


def test_only_native_functions_on_the_way(spark):
    frame = QUERIES["op8_exact_dedup"](spark, "/root/testdata/sf0.001")
    text = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)
