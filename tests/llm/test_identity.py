"""Rows without an id, with repeated ids and repeated as a whole: one rule in every operator that removes or places rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hopgrid.llm import common, exact_dedup, language, sharding, simhash, suffix_dedup
from test_simhash import plain_components

SCHEMA = "doc_id long, text string, n_chars long, _doc string, _row int"


def documents():
    """A third without an id, ids with several texts, rows repeated as a whole."""
    rng = random.Random(5)
    word = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passages = [word(40) for _ in range(4)]
    rows = []
    for k in range(90):
        doc = None if k % 3 == 0 else rng.randint(0, 40)
        rows.append((doc, rng.choice([passages[k % 4], f"{word(9)} {passages[k % 4]}", word(30), "", None, f"same  text {k % 5}"])))
    return rows + rows[:12] + [(1, "once more")] * 30


def frame(spark, rows):
    return spark.createDataFrame([(i, t, len(t or ""), "x", 1) for i, t in rows], SCHEMA).repartition(5)


def test_identified(spark):
    rows = documents()
    got = common.identified(frame(spark, rows).drop("_doc"), "doc_id", "text", "t").orderBy("_doc").collect()
    assert [r["_doc"] for r in got] == list(range(len(rows)))
    assert [(r.doc_id is None, r.doc_id or 0) for r in got] == sorted((i is None, i or 0) for i, _ in rows)
    unique = common.identified(spark.range(5).selectExpr("id * 7 as doc_id", "'x' as text"), "doc_id", "text", "t").collect()
    assert [r["_doc"] for r in unique] == [r.doc_id for r in unique]


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    rows = documents()
    groups = defaultdict(list)
    for i, t in rows:
        groups[" ".join((t or "").split(" ")).replace("  ", " ")].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    stays = exact_dedup.drop_exact_duplicates(frame(spark, rows)).collect()
    assert Counter(((r.text or "").replace("  ", " "), r.doc_id) for r in stays) == Counter(least.items())
    flags = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert len(flags) == len(rows) and sum(r.kept for r in flags) == len(groups)
    assert all(r.doc_id == r.keep_id for r in flags if r.kept)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    rows = documents()
    numbered = [(k, t or "") for k, (_, t) in enumerate(rows)]
    component = {k: c for k, (_, c) in plain_components(numbered).items()}
    best = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        best[component[k]].append((i is None, i or 0))
    stays = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stays) == sorted(map(min, best.values()))
    assert simhash.drop_near_duplicates(frame(spark, rows)).columns == frame(spark, rows).columns


def cut(rows):
    seen, out = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(raw[i:i + 100])
        out.append(bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return out


def test_suffix_dedup_takes_rows_one_by_one(spark):
    rows = documents()
    # The order within an id is by Spark's hash of the text.
    hashes = {r.text: r.h for r in frame(spark, rows).select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    want = Counter((i, len((t or "").encode()), hashlib.sha256(k).hexdigest()) for (i, t), k in zip(rows, cut(rows)))
    got = suffix_dedup.remove_repeats(frame(spark, rows).drop("_doc"))
    assert Counter((r.doc_id, r.n_bytes, r.kept_sha256) for r in got.collect()) == want
    new = suffix_dedup.rewrite_repeats(frame(spark, rows).drop("_doc")).collect()
    assert Counter((r.doc_id, r.text or "", r.n_chars) for r in new) == Counter(
        (i, k.decode(), len(k.decode())) for (i, _), k in zip(rows, cut(rows)))


def test_repeat_stays_in_the_first_of_two_rows_with_one_id(spark):
    rng = random.Random(1)
    z = "".join(rng.choice("abcdefgh ") for _ in range(150))
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(7, z), (7, "twenty other bytes.." + z)], "doc_id long, text string")).collect()
    assert sorted(r.n_removed for r in got) == [0, 150]


@pytest.mark.parametrize("same", [0, 400])
def test_shards_divide_rows_without_an_id(spark, same):
    rows = [(None, "one and the same text")] * same + [(i, "x" * (i % 50)) for i in range(600)]
    got = sharding.shards(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, size int"), 8).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 2 * 66 + 0.002 * sum(sizes.values())


def test_without_languages_only_texts_without_letters_go(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 ...", None), (3, None, None), (4, "mots", None)],
                                 "doc_id long, text string, lang string")
    assert {r.doc_id for r in language.drop_unidentified(docs).collect()} == {1, 4}
