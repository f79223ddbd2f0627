"""SimHash near-duplicates by the generalised pigeonhole principle.

Two 64-bit fingerprints link when at most ``RADIUS`` bits differ. The bits are
split into parts, correlated bits together. If thresholds t_i (-1: part not
used) satisfy sum(t_i + 1) = RADIUS + 1, linked fingerprints agree within t_i
bits in at least one part. Each fingerprint takes its own thresholds: dynamic
programming picks those with the fewest expected candidates, from counts of
all fingerprints by part value. It then probes the part values within its
thresholds, and every candidate is verified on the whole fingerprint.

Only distinct fingerprints are probed, so copies cost nothing here. A bucket
with many fingerprints is split over tasks by its probes. A task does not emit
the links of a bucket but its connected groups, one row per member, so output
stays linear; groups are then joined by ``components``.

Null texts count as empty; texts without words have fingerprint zero and are
linked like any other. Rows with a null id take part in groups but never name
one; a group of only such rows has a null ``component_id``. Repeated rows get
equal results; ``drop_near_duplicates`` keeps exactly one row of each group. An
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from hopgrid.llm.common import components, one_of_each, roots_of, stored, text_or_empty

RADIUS = 4
SHINGLE = 4
SEED = 42            # of XXH64
BUCKET = 4096        # probes of a bucket beyond which tasks share it
PAIRS = 1 << 21      # candidates compared in one step
PROBE_COST = 10      # cost of shuffling a probe against that of comparing a candidate


def fingerprint(text: str) -> int:
    """Bits set in over half of the shingle hashes, as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII only
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest, total, ones = xxhash.xxh64_intdigest, len(words) - width + 1, np.zeros(64, np.int64)
    spans = zip(starts, ends[width - 1:])
    while True:
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in itertools.islice(spans, 65536)), np.uint64)
        if not hashes.size:
            break
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (long), fp (long: the 64 bits), and the ``carry`` columns (long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *carry])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"), *carry)
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in ["doc_id", "fp", *carry]))


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _column(batch: pa.RecordBatch, i: int = 0) -> np.ndarray:
    return batch.column(i).to_numpy(zero_copy_only=False)


def ball(width: int, radius: int) -> int:
    """Values within ``radius`` bits of one of ``width`` bits."""
    size, term = 0, 1
    for r in range(radius + 1):
        size += term
        term = term * (width - r) // (r + 1)
    return size


def part_count(n: int) -> int:
    """Number of parts with the least cost for ``n`` fingerprints if bits were even and independent.

    Five parts would probe five values only, but compare ``n * n / 1600``
    candidates; three and four parts keep the probes within a factor of three.
    """
    def cost(m: int) -> float:
        width = 64 // m
        each = [(RADIUS + 1) // m + (i < (RADIUS + 1) % m) - 1 for i in range(m)]
        return sum(ball(width, e) * (PROBE_COST + n / 2.0 ** width) for e in each if e >= 0)
    return min((3, 4), key=cost)


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Bits 0 to 63 in ``m`` parts, strongly correlated ones together. together[i, j]: rows with both bits."""
    share = together / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    phi = np.abs(share - np.outer(p, p)) / spread
    np.fill_diagonal(phi, 0)
    left, parts = set(range(64)), []
    for k in range(m):
        width = len(left) // (m - k)
        part = [max(left, key=lambda b: (phi[b, sorted(left)].sum(), -b))]
        left.discard(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (phi[b, part].sum(), -b)))
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def part_values(fps: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(fps.size, np.int64)
    for k, bit in enumerate(part):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


FOLD = 16  # counts are kept by at most so many bits of a part value


def ball_counts(counts: np.ndarray, width: int, radius: int) -> list[np.ndarray]:
    """For each folded value the expected candidates within 0..radius bits."""
    folded, index = min(width, FOLD), np.arange(counts.size)
    rings = [counts]
    for r in range(1, radius + 1):
        ring = sum((rings[-1][index ^ (1 << b)] for b in range(folded)), np.zeros_like(counts))
        if r > 1:
            ring = ring - (folded - r + 2) * rings[-2]
        rings.append(ring / r)
    scale = 2.0 ** (folded - width)
    return [np.cumsum(rings, 0)[r] * scale * (ball(width, r) / ball(folded, r)) for r in range(radius + 1)]


def allocate(values: list[np.ndarray], widths: list[int], expected: list[list[np.ndarray]]) -> np.ndarray:
    """Thresholds (rows x parts, -1 to 2) with sum(t + 1) = RADIUS + 1 and the least expected cost."""
    n, units = values[0].size, RADIUS + 1
    best, choices = np.full((n, units + 1), np.inf), []
    best[:, 0] = 0
    for value, width, table in zip(values, widths, expected):
        folded = value & ((1 << min(width, FOLD)) - 1)
        nxt, choice = best.copy(), np.zeros((n, units + 1), np.int8)
        for t in range(3):
            price = table[t][folded] + PROBE_COST * ball(width, t)
            for u in range(t + 1, units + 1):
                cost = best[:, u - t - 1] + price
                better = cost < nxt[:, u]
                nxt[better, u], choice[better, u] = cost[better], t + 1
        best = nxt
        choices.append(choice)
    out, left, rows = np.zeros((n, len(values)), np.int8), np.full(n, units), np.arange(n)
    for i in range(len(values) - 1, -1, -1):
        took = choices[i][rows, left]
        out[:, i], left = took - 1, left - took
    return out


def near_masks(width: int, radius: int) -> np.ndarray:
    """Bit masks of 1 to ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for r in range(1, radius + 1)
                     for c in itertools.combinations(range(width), r)], np.int64)


class Plan:
    """Parts and counts: what every task needs to place fingerprints. Its size does not grow with the input."""

    def __init__(self, distinct: DataFrame):
        def pairs(batches):
            together = np.zeros((64, 64))
            for batch in batches:
                for at in range(0, batch.num_rows, 65536):
                    bits = _bits(_column(batch.slice(at, 65536)).view(np.uint64)).astype(np.float32)
                    together += bits.T @ bits
            i, j = np.nonzero(together)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(together[i, j].astype(np.int64))],
                ["i", "j", "n"])

        self.total = distinct.count()
        summed = distinct.select("fp").mapInArrow(pairs, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
        table = summed.toArrow()  # 4096 rows at most
        together = np.zeros((64, 64))
        together[table["i"].to_numpy(), table["j"].to_numpy()] = table["n"].to_numpy()
        self.parts = parts = group_bits(together, self.total, part_count(self.total))
        self.widths = [len(p) for p in parts]

        def counts(batches):
            tables = [np.zeros(1 << min(len(p), FOLD), np.int64) for p in parts]
            for batch in batches:
                fps = _column(batch).view(np.uint64)
                for p, t in zip(parts, tables):
                    t += np.bincount(part_values(fps, p) & (t.size - 1), minlength=t.size)
            for k, t in enumerate(tables):
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(at.size, k, np.int32)), pa.array(at.astype(np.int32)), pa.array(t[at])],
                    ["part", "value", "n"])

        table = (distinct.select("fp").mapInArrow(counts, "part int, value int, n long")
                 .groupBy("part", "value").agg(F.sum("n").alias("n")).toArrow())  # parts x 65536 rows at most
        part, value, n = (table[c].to_numpy() for c in ("part", "value", "n"))
        self.counts = []
        for k, p in enumerate(parts):
            t = np.zeros(1 << min(len(p), FOLD))
            t[value[part == k]] = n[part == k]
            self.counts.append(t)

    def probes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """part, value, salt, fp, kind (1: is indexed here, 2: probes, 3: both)."""
        expected = [ball_counts(c, w, 2) for c, w in zip(self.counts, self.widths)]
        masks = [{t: near_masks(w, t) for t in (1, 2)} for w in self.widths]
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                fps = _column(batch.slice(at, 8192)).view(np.uint64)
                values = [part_values(fps, p) for p in self.parts]
                chosen = allocate(values, self.widths, expected)
                for k, (value, width) in enumerate(zip(values, self.widths)):
                    t = chosen[:, k]
                    yield from self._rows(k, width, value, fps, 1 + 2 * (t >= 0))
                    for radius in (1, 2):
                        rows = np.flatnonzero(t == radius)
                        if rows.size:
                            mask = masks[k][radius]
                            yield from self._rows(k, width, (value[rows, None] ^ mask).ravel(),
                                                  np.repeat(fps[rows], mask.size), np.full(rows.size * mask.size, 2))

    def _rows(self, k, width, value, fps, kind):
        held = self.counts[k][value & (self.counts[k].size - 1)] * 2.0 ** (min(width, FOLD) - width)
        shares = np.maximum(1, np.ceil(held / BUCKET)).astype(np.int64)
        own = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shares
        copies = np.where(kind & 1, shares, 1)
        row = np.repeat(np.arange(value.size), copies)
        salt = np.arange(row.size) - np.repeat(np.cumsum(copies) - copies, copies)
        salt = np.where(kind[row] & 1, salt, own[row])
        kind = np.where((kind[row] & 1) & (salt != own[row]), 1, kind[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(row.size, k, np.int32)), pa.array(value[row]), pa.array(salt),
             pa.array(fps[row].view(np.int64)), pa.array(kind.astype(np.int32))],
            ["part", "value", "salt", "fp", "kind"])


def _verify(queries: np.ndarray, low: np.ndarray, high: np.ndarray, indexed: np.ndarray):
    """Links of queries[i] with indexed[low[i]:high[i]], as groups: (member, smallest member) in steps."""
    counts = high - low
    at = 0
    while at < queries.size:
        upto = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), PAIRS)) + at)
        n = counts[at:upto]
        first = np.repeat(np.arange(at, upto), n)
        second = np.arange(first.size) - np.repeat(np.cumsum(n) - n, n) + low[first]
        x, y = queries[first], indexed[second]
        close = (np.bitwise_count(x ^ y) <= RADIUS) & (x != y)
        x, y = x[close], y[close]
        if x.size:
            nodes, place = np.unique(np.concatenate([x, y]).view(np.int64), return_inverse=True)
            root = roots_of(nodes.size, place[:x.size], place[x.size:])
            yield nodes, nodes[root]
        at = upto


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted probes to groups. A bucket may cross batches: its rows are carried to the next."""
    def links(rows: list[np.ndarray]):
        part, value, salt, fp, kind = rows
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (salt[1:] != salt[:-1])])
        bucket = np.cumsum(np.r_[False, (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (salt[1:] != salt[:-1])])
        indexed, asks = np.flatnonzero(kind & 1), np.flatnonzero(kind & 2)
        held = np.zeros(starts.size + 1, np.int64)
        np.add.at(held, bucket[indexed] + 1, 1)
        held = np.cumsum(held)
        fps = fp.view(np.uint64)
        b = bucket[asks]
        for nodes, root in _verify(fps[asks], held[b], held[b + 1], fps[indexed]):
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root)], ["a", "b"])

    kept = None
    for batch in batches:
        rows = [np.ascontiguousarray(_column(batch, i)) for i in range(5)]
        if not rows[0].size:
            continue
        if kept is not None:
            rows = [np.concatenate(x) for x in zip(kept, rows)]
        last = [r[-1] for r in rows[:3]]
        open_from = int(np.flatnonzero((rows[0] != last[0]) | (rows[1] != last[1]) | (rows[2] != last[2]))[-1:].sum() + 1) \
            if any((r[0] != x) for r, x in zip(rows[:3], last)) else 0
        if open_from:
            yield from links([r[:open_from] for r in rows])
        kept = [r[open_from:] for r in rows]
    if kept is not None:
        yield from links(kept)


def near_groups(prints: DataFrame) -> DataFrame:
    """fp, component_id (smallest id) and component (its name) for every distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprints")
    plan = Plan(distinct)
    found = (distinct.select("fp").mapInArrow(plan.probes, "part int, value long, salt long, fp long, kind int")
             .repartition("part", "value", "salt").sortWithinPartitions("part", "value", "salt")
             .mapInArrow(_bucket_links, "a long, b long"))
    member = components(found)
    placed = distinct.join(member, distinct.fp == member.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))
    names = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    return stored(placed.join(names, "component").select("fp", "component_id", "component"), "near-groups")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, doc_id, text), "document-fingerprints")
    return prints.join(near_groups(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group, with all its columns: smallest id, rows without an id last, then smallest hash of the text."""
    hashed = docs.withColumns({"_hash": F.xxhash64(text_or_empty(text)), "_own": F.col(doc_id).cast("long")})
    prints = stored(fingerprints(hashed, doc_id, text, ("_hash",)), "document-fingerprints")
    rows = prints.groupBy("doc_id", "_hash", "fp").agg(F.count("*").alias("_rows"))
    groups = near_groups(prints).select("fp", "component")
    first = rows.join(groups, "fp").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_own"), "_hash", "_rows")).alias("w"))
    keys = {"_own": F.col(doc_id).cast("long"), "_hash": F.xxhash64(text_or_empty(text))}
    return one_of_each(docs, keys, first.select("w._own", "w._hash", "w._rows"))
