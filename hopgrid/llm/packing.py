"""Best-fit-decreasing packing of token sequences.

Documents become ids and a closing id; only longer ones are cut, the first
piece takes what does not fill a sequence. Pieces are packed largest first,
each into the open sequence with the least room that suffices.

Which piece of a length is taken does not matter for the result, nor which of
several sequences with equal room. So the packing is planned on the number of
pieces per length (at most ``capacity`` numbers, whatever the input) with a
segment tree over the rooms that open sequences have; each step serves many
equal pieces. Every piece then finds its place by its length and its rank among
pieces of that length. Ranks are counted in two levels, so a length that a
third of all pieces share is spread over tasks.

Null texts count as empty and give the closing id alone. Rows with a null id
and repeated rows are packed like others. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hopgrid.llm.bpe import tokenizer
from hopgrid.llm.common import stored, text_or_empty

CAPACITY = 1024
END = 2
LEAST_BIN, MOST_BINS = 256, 4096   # rows per rank bin wanted, and rank bins of a length at most


class Rooms:
    """Open sequences by room, as runs (first, count), with a segment tree that tells which rooms there are."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs = [deque() for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += n
            node //= 2

    def put(self, room: int, first: int, count: int) -> None:
        if count:
            self.runs[room].append((first, count))
            self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].popleft()

    def tightest(self, least: int) -> int | None:
        """Smallest room of at least ``least`` that an open sequence has."""
        node = least + self.leaves
        while node > 1 and not self.tree[node]:
            while node > 1 and node % 2:   # a right child: go up
                node //= 2
            if node == 1:
                return None
            node += 1                      # the sibling to the right
        if node <= 1:
            return None
        while node < self.leaves:
            node *= 2
            if not self.tree[node]:
                node += 1
        return node - self.leaves


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Steps (length, first rank, first sequence, offset), each up to the next step of its length."""
    rooms, steps, new = Rooms(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, fits = capacity, capacity // length
                first, count = new, -(-left // fits)
                new += count
            else:
                first, count = rooms.take(room)
                fits = room // length
            # Best fit puts further pieces of this length on top, as that room is now the tightest.
            whole = min(count, left // fits)
            for level in range(fits if whole else 0):
                steps.append((length, rank, first, capacity - room + level * length))
                rank += whole
            rooms.put(room - fits * length, first, whole)
            left -= whole * fits
            if whole < count and left:
                some = min(left, fits)
                for level in range(some):
                    steps.append((length, rank, first + whole, capacity - room + level * length))
                    rank += 1
                left -= some
                rooms.put(room - some * length, first + whole, 1)
                whole += 1
            rooms.put(room, first + whole, count - whole)
    return steps


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
           with_ids: bool = True) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32, ids (packed; null unless ``with_ids``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = tokenizer(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            out = [[] for _ in range(6)]
            for i, doc in enumerate(batch.column(0).to_pylist()):
                ids = bpe.encode(batch.column(1)[i].as_py()) + end
                total, at, number = len(ids) // 4, 0, 0
                while at < total:
                    n = (total - at) % capacity or capacity
                    part = ids[4 * at:4 * (at + n)]
                    for column, value in zip(out, (doc, number, at, n, zlib.crc32(part), part if with_ids else None)):
                        column.append(value)
                    at, number = at + n, number + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             [n.split()[0] for n in PIECE.split(", ")])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, PIECE)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = True) -> DataFrame:
    """Pieces with sequence_id and offset, the place in that sequence."""
    cut = stored(pieces(docs, path, capacity, doc_id, text, with_ids), "pieces")
    bins = max(1, min(MOST_BINS, cut.count() // LEAST_BIN))
    cut = cut.withColumn("_bin", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(bins)).cast("int"))
    sizes = stored(cut.groupBy("length", "_bin").agg(F.count("*").alias("_n")), "piece-counts")
    # At most MOST_BINS rows a length.
    before = Window.partitionBy("length").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select("length", "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_head"))
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    steps = sorted(plan(counts, capacity))
    length_, rank_, first_, offset_ = (np.array(c, np.int64) for c in zip(*steps)) if steps else [np.zeros(0, np.int64)] * 4
    keys = (length_ << 44) | rank_

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            columns = [batch.column(i) for i in range(6)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first_[at] + rank - rank_[at]), pa.array(offset_[at])],
                [*(n.split()[0] for n in PIECE.split(", ")), "sequence_id", "offset"])

    order = Window.partitionBy("length", "_bin").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.join(heads, ["length", "_bin"]).withColumn("_rank", F.col("_head") + F.row_number().over(order) - 1)
    return ranked.select(*(n.split()[0] for n in PIECE.split(", ")), F.col("_rank").cast("long").alias("_rank")).mapInArrow(
        place, PIECE + ", sequence_id long, offset long")
