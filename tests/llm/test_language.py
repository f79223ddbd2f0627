"""Language identification: plain out-of-place distance, and held-out accuracy."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa

from hopgrid.llm import common, language

WORDS = {"aa": "the of and tion ing her", "bb": "der und schön über keit", "cc": "que él ción los año"}


def rows():
    out = [(0, None, "aa"), (1, "", "aa"), (2, "12 ... 34", "bb"), (3, "the the", None), (4, "日本", "aa")]
    for i in range(5, 120):
        lang = sorted(WORDS)[i % 3]
        parts = WORDS[lang].split()
        out.append((i, " ".join(parts[(i * k) % len(parts)] for k in range(1, 40)), lang))
    return out


def grams(text):
    clean = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + text.lower().encode() + b" ")
    found = Counter()
    for n in range(1, 5):
        found.update(g for i in range(len(clean) - n + 1) if (g := clean[i:i + n]) != b" ")
    return found


def ordered(counts, n):
    return sorted(counts, key=lambda g: (-counts[g], int.from_bytes(g)))[:n]


def test_against_plain_version(spark):
    data = rows()
    frame = spark.createDataFrame([(*r, 1.0) for r in data], "doc_id long, text string, lang string, score double")
    profiles = {}
    for i, text, lang in data:
        if text is not None and lang and zlib.crc32(str(i).encode()) % 5:
            profiles.setdefault(lang, Counter()).update(grams(text))
    profiles = {k: {g: r for r, g in enumerate(ordered(c, language.PROFILE))} for k, c in profiles.items()}
    for r in language.identify(frame).collect():
        text = data[r.doc_id][1]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if not text or not re.search(r"[^\W\d_]", text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        own = ordered(grams(text), language.OWN)
        distance = {k: sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(sorted(distance), key=distance.get)
        assert r.lang_pred == best
        assert abs(r.score - (1 - distance[best] / (len(own) * language.PROFILE))) < 1e-9 or r.score == 0
    kept = {r.doc_id for r in language.drop_unidentified(frame).collect()}
    assert kept >= {i for i, t, _ in data if i > 4} and not kept & {0, 1, 2}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = docs.select("doc_id", "lang").join(language.identify(docs).where("held_out"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in pairs) >= 0.9 * len(pairs)


def test_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "a text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(frame).collect()] == ["und"]
    assert language.identify(frame.where("false")).count() == 0


def test_batches_are_cut_by_bytes_without_losing_rows():
    texts = ["a" * 10, None, "", "é" * 30, "b", None, "c" * 100, "d"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": list(range(8))})
    parts = list(common.batch_slices(batch, "text", 50))
    assert [v for p in parts for v in p.column(1).to_pylist()] == list(range(8))
    assert all(sum(len((t or "").encode()) for t in p.column(0).to_pylist()) <= 50 or p.num_rows == 1 for p in parts)
    assert list(common.batch_slices(batch.slice(0, 0), "text")) == []
