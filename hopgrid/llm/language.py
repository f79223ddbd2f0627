"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent n-grams of a language, most frequent first.
A document's own most frequent n-grams are compared with each profile: every
n-gram adds the distance between its two ranks, or the profile's length where
the profile lacks it. The language with the smallest sum wins.

N-grams are runs of 1 to 4 bytes of the lower-cased text in which everything
but letters became single spaces. Profiles are counted over all documents that
may be learned from (``held_out`` ones and those without a language are not).

Null texts, and texts without a letter, give ``und`` with score 0. The score is
1 - distance / largest possible distance. Ties go to the language that sorts
first. Without anything to learn from, every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from hopgrid.llm.common import batch_slices, held_out, text_blocks

PROFILE = 400      # n-grams of a profile
OWN = 300          # n-grams of a document
LONGEST = 4
PREDICT_BYTES = 1 << 19   # text bytes whose n-grams are sorted in one step
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

# Bytes that may stand in a letter: a to z and those of multi-byte characters; the rest becomes a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of some texts, and the text each is from. A code is the bytes as a number."""
    raws = [b" " + t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = _FOLD[np.frombuffer(b"".join(raws), np.uint8)]
    owner = np.repeat(np.arange(len(raws), dtype=np.int32), [len(r) for r in raws])
    keep = np.r_[True, (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])]
    data, owner = data[keep].astype(np.uint32), owner[keep]
    codes, owners, code = [], [], data
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = (code[:-1] << np.uint32(8)) | data[n - 1:]
        inside = owner[:code.size] == owner[n - 1:]
        inside &= code != 32
        codes.append(code[inside])
        owners.append(owner[:code.size][inside])
    return np.concatenate(codes), np.concatenate(owners)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text to lang, gram, n: one row per language and n-gram of a task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts):
            rows.setdefault(lang, []).append(text)
        for lang, own in rows.items():
            for low, high in text_blocks(own, PREDICT_BYTES):
                grams, n = np.unique(gram_codes(own[low:high])[0], return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], grams])
                    grams, place = np.unique(both, return_inverse=True)
                    n = np.bincount(place, weights=np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = grams, n
        if sum(g.size for g, _ in held.values()) > 1_000_000:
            yield from _counts(held)
            held = {}
    yield from _counts(held)


def _counts(held):
    for lang, (grams, n) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * grams.size, pa.string()), pa.array(grams.astype(np.int64)),
                                          pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def learn_profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, rank (from 0): PROFILE rows a language at most."""
    rows = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # First within shares of the n-grams, so that no task sorts all n-grams of a language.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(F.desc("n"), "gram")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= PROFILE)
    return best.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < PROFILE).drop("n")


class Profiles:
    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.int64)).astype(np.uint32)
        self.ranks = np.full((self.grams.size + 1, len(self.langs)), -1, np.int64)
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), place[lang]] = rank

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        asked = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)] if self.langs else []
        for low, high in text_blocks([texts[i] for i in asked], PREDICT_BYTES):
            block = asked[low:high]
            codes, owner = gram_codes([texts[i] for i in block])
            keys = np.sort((owner.astype(np.uint64) << np.uint64(32)) | codes)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            counts = np.diff(np.r_[starts, keys.size])
            keys = keys[starts]
            owner, grams = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
            order = np.lexsort((grams, -counts, owner))
            owner, grams = owner[order], grams[order]
            first = np.searchsorted(owner, np.arange(len(block)))
            rank = np.arange(owner.size) - first[owner]
            top = rank < OWN
            owner, grams, rank = owner[top], grams[top], rank[top]
            at = np.searchsorted(self.grams, grams)
            at[(at == self.grams.size) | (self.grams[np.minimum(at, self.grams.size - 1)] != grams)] = self.grams.size
            theirs = self.ranks[at]
            apart = np.where(theirs < 0, PROFILE, np.abs(theirs - rank[:, None]))
            begin = np.searchsorted(owner, np.arange(len(block)))
            total = np.add.reduceat(apart, begin, axis=0)
            size = np.bincount(owner, minlength=len(block))
            best = total.argmin(1)
            for k, i in enumerate(block):
                names[i] = self.langs[best[k]]
                scores[i] = float(max(0.0, 1 - total[k, best[k]] / (size[k] * PROFILE)))
        return names, scores


def predict(docs: DataFrame, profiles: list[tuple[str, int, int]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score; ``profiles``: rows of ``learn_profiles``."""
    model = Profiles(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def _profile_rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, int, int]]:
    return [tuple(r) for r in learn_profiles(docs, doc_id, text, lang).collect()]  # PROFILE rows a language


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from ``docs`` and predict each of its rows: doc_id, held_out, lang_pred, score."""
    return predict(docs, _profile_rows(docs, doc_id, text, lang), doc_id, text)


def drop_unidentified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that have a language: not ``und``, and nearer to its profile than the largest distance.

    Without any language to learn only texts without a letter go.
    """
    model = Profiles(_profile_rows(docs, doc_id, text, lang))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch_slices(batch, text, PREDICT_BYTES):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                names, scores = model.predict(texts)
                known_ = [n != UNKNOWN and s > 0 for n, s in zip(names, scores)] if model.langs else [bool(t and LETTER.search(t)) for t in texts]
                yield part.filter(pa.array(known_, pa.bool_()))

    return docs.mapInArrow(known, docs.schema)
