"""Shards of nearly equal bytes by histogram sort.

Documents are ordered by (hash of the text, hash of id and place in the input),
so equal texts lie together and any number of them can be divided.
Shard boundaries are found without sorting: every round counts the exact bytes
below many probe keys over all partitions, and keeps for each boundary the two
probes around its target, until one is within the tolerance or only one
document lies in between. Then rows go to their shard in one exchange.

A null text has no bytes and hashes as the empty text. Rows without an id and
repeated rows are rows of their own with keys of their own. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hopgrid.llm.common import stored, text_or_empty

OVERHEAD = 16          # bytes a document counts besides its text
TOLERANCE = 0.001      # of a shard's bytes
PROBES = 1024          # probe keys per open boundary and round
MOST_BINS, LEAST_BIN = 4096, 64
TOP = 1 << 128
_SIGN = np.uint64(1 << 63)


def keys_of(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Keys as 16 bytes that order like (h, id)."""
    pair = np.empty((h.size, 2), ">u8")
    pair[:, 0], pair[:, 1] = h.view(np.uint64) ^ _SIGN, ids.view(np.uint64) ^ _SIGN
    return pair.view("S16").ravel()


def _packed(keys: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(k.to_bytes(16, "big") for k in keys), "S16") if keys else np.zeros(0, "S16")


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [np.ascontiguousarray(batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)) for n in names]


def histogram(table: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows below each of the sorted ``probes``, and in all at the end."""
    places = _packed(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_bytes, n_rows = np.zeros(places.size + 1, np.int64), np.zeros(places.size + 1, np.int64)
        for batch in batches:
            h, ids, size = _columns(batch, "h", "_id", "size")
            at = np.searchsorted(places, keys_of(h, ids), side="right")
            np.add.at(n_bytes, at, size)
            n_rows += np.bincount(at, minlength=n_rows.size)
        some = np.flatnonzero(n_rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n_bytes[some]), pa.array(n_rows[some])], ["at", "b", "r"])

    rows = (table.select("h", "_id", "size").mapInArrow(run, "at long, b long, r long")
            .groupBy("at").agg(F.sum("b").alias("b"), F.sum("r").alias("r")).collect())  # one row per probe at most
    n_bytes, n_rows = np.zeros(places.size + 1, np.int64), np.zeros(places.size + 1, np.int64)
    for row in rows:
        n_bytes[row.at], n_rows[row.at] = row.b, row.r
    return np.cumsum(n_bytes), np.cumsum(n_rows)


def splitters(table: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """``shards`` - 1 keys; a row's shard is the number of keys that are not above its own."""
    total, count, low_id, high_id = table.agg(F.sum("size"), F.count("*"), F.min("_id"), F.max("_id")).first()
    if not count:
        return [TOP - 1] * (shards - 1)
    slack = max(tolerance * total / shards, total / count / 2)
    low_id, high_id = low_id + 2**63, high_id + 2**63
    # Per boundary: key, bytes and rows below, on both sides of its target.
    low = [(0, 0, 0)] * (shards - 1)
    high = [(TOP - 1, total, count)] * (shards - 1)
    target = [total * (i + 1) / shards for i in range(shards - 1)]
    done: dict[int, int] = {}
    while len(done) < shards - 1:
        probes = set()
        for i in range(shards - 1):
            if i in done:
                continue
            a, b = low[i][0], high[i][0]
            if a >> 64 == (b - 1) >> 64:  # one text: only its ids are left to tell apart
                base = a >> 64 << 64
                a, b = max(a, base | low_id), min(b, (base | high_id) + 1)
            step = max(1, (b - a) // (PROBES + 1))
            probes.update(k for k in (a + j * step for j in range(1, PROBES + 1)) if a < k < b)
            probes.update((a, b))
        probes = sorted(k for k in probes if 0 <= k < TOP)
        n_bytes, n_rows = histogram(table, probes)
        for i in range(shards - 1):
            if i in done:
                continue
            at = int(np.searchsorted(n_bytes[:-1], target[i]))
            if at < len(probes) and n_bytes[at] < high[i][1] or at < len(probes) and probes[at] < high[i][0]:
                high[i] = min(high[i], (probes[at], int(n_bytes[at]), int(n_rows[at])))
            if at and probes[at - 1] > low[i][0]:
                low[i] = (probes[at - 1], int(n_bytes[at - 1]), int(n_rows[at - 1]))
            best = min(low[i], high[i], key=lambda x: abs(x[1] - target[i]))
            if abs(best[1] - target[i]) <= slack or high[i][2] - low[i][2] <= 1 or high[i][0] - low[i][0] <= 1:
                done[i] = best[0]
    return [done[i] for i in range(shards - 1)]


def shard_of(keys: list[int]) -> Column:
    """A column function (hash, id) -> shard for given splitters."""
    places = _packed(keys)

    @F.pandas_udf("int")
    def find(h, ids):
        import pandas as pd
        return pd.Series(np.searchsorted(places, keys_of(h.to_numpy(np.int64), ids.to_numpy(np.int64)), side="right"))

    return find


def key_columns(doc_id: str, text: str) -> list[Column]:
    """Hash of the text, and a number that tells all rows apart, also those with equal ids and texts or without an id."""
    row = F.xxhash64(F.col(doc_id).cast("long"), F.monotonically_increasing_id())
    return [F.xxhash64(text_or_empty(text)).alias("h"), row.alias("_id")]


def shards(docs: DataFrame, count: int = 40, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    table = stored(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), *key_columns(doc_id, text),
        (F.octet_length(text_or_empty(text)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text_or_empty(text).cast("binary")).alias("text_crc32")), "shard-keys")
    find = shard_of(splitters(table, count))
    placed = table.withColumn("shard", find("h", "_id"))
    bins = max(1, min(MOST_BINS, table.count() // count // LEAST_BIN))
    placed = stored(placed.withColumn("_bin", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(bins)).cast("int")).drop("h"), "shards")
    # Slots in two levels: places of bins in their shard, then rows in their bin.
    sizes = placed.groupBy("shard", "_bin").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select("shard", "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_head"))
    order = Window.partitionBy("shard", "_bin").orderBy("_id", "text_crc32")
    return placed.join(heads, ["shard", "_bin"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_head") + F.row_number().over(order) - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, count: int = 40, doc_id: str = "doc_id", text: str = "text", files: int = 8) -> None:
    """Write whole documents to ``path``/shard=0.. in one exchange, each shard over ``files`` tasks."""
    keys = splitters(stored(docs.select(*key_columns(doc_id, text), (F.octet_length(text_or_empty(text)) + OVERHEAD)
                                        .cast("long").alias("size")), "shard-keys"), count)
    h, ids = key_columns(doc_id, text)
    placed = docs.withColumns({"_h": h, "_row": ids})
    placed = placed.withColumn("shard", shard_of(keys)("_h", "_row")).drop("_h", "_row")
    placed.repartition(count * files, "shard", F.pmod(F.xxhash64(doc_id), F.lit(files))).write.partitionBy("shard").parquet(path)
