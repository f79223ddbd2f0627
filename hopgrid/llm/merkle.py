"""Merkle manifest of a dataset: a postorder append log with closed-form addresses.

Every document is a leaf; the leaves of a source, by id, form a tree of runs
of three, and the subroots of the sources, by name, form one more. ``H`` is the
lowercase hex SHA-256 of its inputs put together, digests as hex text.

1. ``leaf_digests``: one digest per document, by SQL functions in the tasks that
   read the texts; only digests go on.
2. ``numbered`` (``common``) gives each leaf its place in its source, without a
   task for a whole source.
3. Aligned builders: 3 ** ``LEVELS`` consecutive leaves of a source are one
   block. Its builder takes them in order and writes every node when its last
   child is there, so the block's log is the postorder of its subtree. The tops
   of blocks are the leaves of the next tier, until one is left; a source of n
   leaves takes log(n) / (``LEVELS`` log 3) tiers, each 3 ** ``LEVELS`` times
   smaller than the one before.
4. ``address``: the place of node (level, index) in the postorder of a tree of n
   leaves follows from the sizes of the subtrees before it, so siblings are
   read from the log by place; nothing is searched or recomputed.
   ``append_log`` lists the whole log of every source with these addresses.
5. ``proofs``: from the top tier down, the path above a block is put in front of
   its rows, which add their own siblings.

A path lists, level by level, ``left|right;``: the digests left and right of
the node in its run. ``fold`` recomputes a root from a leaf and a path.

Nulls: a null field is ``-``; a null source is a source of its own, the first;
null ids come first in their source. Rows of a source with equal ids are
ordered by their digests; wholly equal rows are leaves of their own, each with
its place. Empty texts are ``0:``. A lone leaf is its subroot and a lone
subroot the root, with an empty path. An empty table has no root and no rows.
"""

from __future__ import annotations

from binascii import hexlify, unhexlify
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hopgrid.llm.common import numbered, sorted_groups, stored

ARITY = 3            # fixed by the manifest's format
LEVELS = 6           # levels of a block: 729 leaves
BATCH = 2048         # rows a task hands on at a time
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    leaves: DataFrame          # group_id, place, size, digest, row (struct)
    tiers: list[DataFrame]     # stored logs: tree, block, size, leaves, height, log
    subroots: DataFrame        # tree, subroot (hex)
    above: list[DataFrame]     # the same for the tree over the sources
    numbers: DataFrame         # group_id, place, size, digest of the subroots, row (struct of tree)
    root: str | None


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a document row; ``changed`` replaces fields."""
    return F.sha2(F.concat(*[_field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def address(level: int, index: int, leaves: int) -> int:
    """Place of a node in the postorder of a tree of ``leaves`` leaves.

    Before it stand the leaves up to its last one, the nodes whose last leaf
    came earlier (leaf // 3 ** l on level l), and its own descendants on the
    right edge, one per level below it.
    """
    last = min((index + 1) * ARITY**level, leaves) - 1
    place, rest = last + level, last // ARITY
    while rest:
        place += rest
        rest //= ARITY
    return place


def height_of(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def write_log(leaves: list[bytes], height: int) -> list[bytes]:
    """Hex digests of all nodes of a block in the order in which they are complete."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def close(level: int) -> None:
        node = sha256(b"".join(open_runs[level])).hexdigest().encode()
        log.append(node)
        open_runs[level].clear()
        open_runs[level + 1].append(node)

    for leaf in leaves:
        log.append(leaf)
        open_runs[0].append(leaf)
        level = 0
        while level < height and len(open_runs[level]) == ARITY:
            close(level)
            level += 1
    for level in range(height):
        if open_runs[level]:
            close(level)
    return log


def paths(log: str, leaves: int, height: int, above: str) -> Iterator[str]:
    """The path of each leaf of a block, siblings read from its log (hex text) by address."""
    widths = [-(-leaves // ARITY**level) for level in range(height)]

    def node(level: int, index: int) -> str:
        at = 64 * address(level, index, leaves)
        return log[at:at + 64]

    def step(level: int, index: int) -> str:
        first = index - index % ARITY
        left = "".join(node(level, i) for i in range(first, index))
        right = "".join(node(level, i) for i in range(index + 1, min(first + ARITY, widths[level])))
        return f"{left}|{right};"

    now, rest = [-1] * height, [""] * height + [above]
    for leaf in range(leaves):
        index, fresh = leaf, 0
        while fresh < height and now[fresh] != index:
            now[fresh] = index
            index //= ARITY
            fresh += 1
        for level in range(fresh - 1, -1, -1):  # what lies above an unchanged node stays
            rest[level] = step(level, now[level]) + rest[level + 1]
        yield rest[0]


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    levels = F.filter(F.split(path, ";"), lambda level: level != "")
    return F.aggregate(levels, leaf, lambda digest, level: F.sha2(
        F.concat(F.substring_index(level, "|", 1), digest, F.substring_index(level, "|", -1)), 256))


def siblings(path: Column) -> Column:
    """The digests of a path alone, level by level, left to right."""
    return F.translate(path, "|;", "")


# --- building ---

def _build_tier(nodes: DataFrame, purpose: str) -> DataFrame:
    """Logs of the blocks of one tier; ``nodes``: tree, place, size, digest (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in sorted_groups(batches, ["tree", "block"]):
            digests = [hexlify(d) for d in rows.column("digest").to_pylist()]
            size = rows.column("size")[0].as_py()
            height = min(LEVELS, height_of(size))
            log = unhexlify(b"".join(write_log(digests, height)))
            yield pa.RecordBatch.from_pylist([{"tree": tree, "block": block, "size": size, "leaves": len(digests),
                                               "height": height, "log": log}], schema=schema)

    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("leaves", pa.int64()),
                        ("height", pa.int32()), ("log", pa.binary())])
    blocks = nodes.select("tree", F.expr(f"place div {ARITY ** LEVELS}").alias("block"), "place", "size", "digest")
    dealt = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return stored(dealt.mapInArrow(run, "tree long, block long, size long, leaves long, height int, log binary"), purpose)


def _build(nodes: DataFrame, purpose: str) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of some trees, and their tops (tree, digest)."""
    span, tiers, tops = ARITY**LEVELS, [], None
    while True:
        tier = _build_tier(nodes, f"{purpose}-{len(tiers)}")
        tiers.append(tier)
        ends = tier.select("tree", "block", "size", F.substring("log", -32, 32).alias("digest"))
        done = ends.where(F.col("size") <= span).select("tree", "digest")
        tops = done if tops is None else tops.union(done)
        nodes = ends.where(F.col("size") > span).select(
            "tree", F.col("block").alias("place"), F.expr(f"(size + {span - 1}) div {span}").alias("size"), "digest")
        if nodes.isEmpty():
            return tiers, tops


def build_manifest(docs: DataFrame, **carry: Column) -> Manifest:
    """Build the logs of all sources and of the tree over them.

    ``carry`` names further columns (of digests, ids and the like) that
    ``proofs`` returns with each row.
    """
    leaves = stored(docs.select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_digest()).alias("leaf"), *[c.alias(name) for name, c in carry.items()]), "merkle-leaves")
    placed = numbered(leaves, ["source"], ["doc_id", "leaf", *carry], "merkle-order").select(
        F.col("group_id").alias("tree"), "place", "size", F.col("leaf").alias("digest"),
        F.struct("doc_id", "source", "leaf", *carry).alias("row"))
    tiers, tops = _build(placed, "merkle-log")
    tops = stored(tops, "merkle-subroots")
    # The ids of the trees ascend as the sources do.
    numbers = numbered(tops, [], ["tree"], "merkle-sources").select(
        F.lit(0).cast("long").alias("tree"), "place", "size", "digest", F.struct("tree").alias("row"))
    above, top = _build(numbers, "merkle-root")
    root = top.select(F.lower(F.hex("digest")).alias("root")).first()
    subroots = tops.select("tree", F.lower(F.hex("digest")).alias("subroot"))
    return Manifest(placed, tiers, subroots, above, numbers, root.root if root else None)


# --- reading the log ---

def _extract(nodes: DataFrame, logs: DataFrame) -> DataFrame:
    """row, path and subroot of every node (tree, place, row) from the logs of its tier with the path above each block."""
    shape = nodes.schema["row"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, out, tops = [], [], []

        def full() -> pa.RecordBatch:
            row = pa.concat_arrays([chunk for part in rows for chunk in part.chunks])
            return pa.RecordBatch.from_arrays([row, pa.array(out, pa.string()), pa.array(tops, pa.string())], ["row", "path", "subroot"])

        for _, group in sorted_groups(batches, ["tree", "block"]):
            head = group.slice(0, 1).to_pylist()[0]  # the log sorts before the rows
            log = hexlify(head["log"]).decode()
            rows.append(group.column("row").slice(1))
            out.extend(paths(log, head["leaves"], head["height"], head["above"]))
            tops.extend([head["subroot"]] * head["leaves"])
            if len(out) >= BATCH:
                yield full()
                rows, out, tops = [], [], []
        if out:
            yield full()

    block = F.expr(f"place div {ARITY ** LEVELS}").alias("block")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("leaves", "long"), ("height", "int"), ("log", "binary"), ("above", "string"), ("subroot", "string"))]
    both = logs.select("tree", "block", F.lit(-1).cast("long").alias("place"), F.lit(None).cast(shape).alias("row"),
                       "leaves", "height", "log", "above", "subroot").unionByName(
        nodes.select("tree", block, "place", "row", *nothing))
    dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return dealt.mapInArrow(run, f"row {shape.simpleString()}, path string, subroot string")


def _descend(leaves: DataFrame, tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """row, path and subroot of every leaf; ``top`` (tree, above, subroot) has the path over each tree's root."""
    span, above = ARITY**LEVELS, None
    for level in range(len(tiers) - 1, -1, -1):
        ends = tiers[level].where(F.col("size") <= span).join(top, "tree")
        logs = ends if above is None else ends.unionByName(tiers[level].where(F.col("size") > span).join(above, ["tree", "block"]))
        if not level:
            return _extract(leaves, logs)
        nodes = tiers[level - 1].where(F.col("size") > span).select(
            "tree", F.col("block").alias("place"), F.struct("tree", "block").alias("row"))
        above = stored(_extract(nodes, logs).select("row.*", F.col("path").alias("above"), "subroot"), "merkle-paths")


def proofs(manifest: Manifest) -> DataFrame:
    """Per document: doc_id, source, leaf (hex), the carried columns, path, subroot, root."""
    whole = manifest.above[-1].select("tree", F.lit("").alias("above"), F.lit("").alias("subroot"))  # one row: one tree
    over = _descend(manifest.numbers, manifest.above, whole).select("row.tree", F.col("path").alias("above"))
    rows = _descend(manifest.leaves, manifest.tiers, stored(over.join(manifest.subroots, "tree"), "merkle-tops"))
    rest = [f"row.{name}" for name in manifest.leaves.schema["row"].dataType.names if name not in ("doc_id", "source", "leaf")]
    return rows.select("row.doc_id", "row.source", F.lower(F.hex("row.leaf")).alias("leaf"), *rest, "path", "subroot",
                       F.lit(manifest.root).cast("string").alias("root"))


def append_log(manifest: Manifest) -> DataFrame:
    """The log of every source: tree, position (gapless from 0), level, index, digest (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for level in range(r["height"] + 1):
                    first = r["block"] * ARITY**(LEVELS - level)
                    for i in range(-(-r["leaves"] // ARITY**level)):
                        at = 32 * address(level, i, r["leaves"])
                        if r["tier"] and not level:
                            continue  # stands in the log of the block below
                        whole = r["tier"] * LEVELS + level
                        rows.append((r["tree"], address(whole, first + i, r["all"]), whole, first + i, r["log"][at:at + 32]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                     ["tree", "position", "level", "index", "digest"])

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    sizes = manifest.tiers[0].where("block = 0").select("tree", F.col("size").alias("all"))
    out = None
    for number, tier in enumerate(manifest.tiers):
        part = tier.join(sizes, "tree").withColumn("tier", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out.mapInArrow(run, "tree long, position long, level int, index long, digest binary")


def verify(proved: DataFrame, presented: str) -> DataFrame:
    """Fold the presented leaf (hex) of each proof: adds folded_root and verified."""
    return proved.withColumn("folded_root", fold(F.col(presented), F.col("path"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
