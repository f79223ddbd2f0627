"""What the operators of this folder share: inputs, stored intermediate tables, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hopgrid.session import work_dir

BLOCK_BYTES = 2 << 20  # text bytes that one numpy step works on


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` to the cluster's shared folder and read it back.

    Cuts the lineage with files that survive a lost executor and keeps
    Python stages from running once per use.
    """
    spark = frame.sparkSession
    path = work_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id's text, modulo 5, is 0 (null ids hash as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def text_blocks(texts: list, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each; a longer text stands alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def batch_slices(batch: pa.RecordBatch, name: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in consecutive parts with about ``limit`` bytes of text in the column ``name`` each; every row is in one part."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, own in enumerate(sizes.tolist()):
        if size and size + own > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += own
    if start < batch.num_rows:
        yield batch.slice(start)


def numbered(rows: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``group_id``, ``place`` in the group by ``order`` (from 0) and ``size`` of the group.

    Nulls come first; group ids ascend as the groups do. Rows are dealt out by
    ranges of (group, order, place in the input), so neither a large group nor
    many equal rows land in one task; only the runs of a group, one per task it
    touches, are added up. ``rows`` should be a stored table: it is read twice,
    and its order must not change when a task runs again.
    """
    keys = [*group, *order, "_input"]
    dealt = rows.withColumn("_input", F.monotonically_increasing_id()).repartitionByRange(*keys)
    dealt = stored(dealt.sortWithinPartitions(*keys).drop("_input").withColumn("_at", F.monotonically_increasing_id()), purpose)
    task = F.shiftright("_at", 33).alias("_task")
    runs = dealt.groupBy(task, *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = Window.partitionBy(*group)
    before = own.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_task", "_first", F.min("_first").over(own).alias("group_id"), F.sum("_n").over(own).alias("size"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), *[F.col(g).alias(f"_run_{g}") for g in group])
    same = [F.col("_task_of") == F.col("_task"), *[F.col(g).eqNullSafe(F.col(f"_run_{g}")) for g in group]]
    joined = dealt.withColumn("_task_of", F.shiftright("_at", 33)).join(runs, same)
    return joined.select(*rows.columns, "group_id", (F.col("_before") + F.col("_at") - F.col("_first")).alias("place"), "size")


def identified(docs: DataFrame, doc_id: str, text: str, purpose: str) -> DataFrame:
    """``docs`` with ``_doc``: a number that no other row has, in the order of the rows.

    The order is by id, nulls last, then by a hash of the whole text, then as the
    rows were read. Where every row has an id of its own the id is the number;
    otherwise rows are numbered, which stores the table once more.
    """
    own = F.col(doc_id).cast("long")
    if docs.groupBy(own.alias("_own")).agg(F.count("*").alias("_n")).where("_own is null or _n > 1").isEmpty():
        return docs.withColumn("_doc", own)
    keyed = docs.withColumns({"_null": own.isNull(), "_own": own, "_hash": F.xxhash64(text_or_empty(text))})
    placed = numbered(stored(keyed, f"{purpose}-rows"), [], ["_null", "_own", "_hash"], f"{purpose}-order")
    return placed.select(*docs.columns, F.col("place").alias("_doc"))


def one_of_each(docs: DataFrame, keys: dict[str, Column], winners: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` for each row of ``winners``: keys, ``_rows`` (rows of docs with these keys).

    Rows with equal keys differ at most in further columns; the one with the
    smallest hash over all of them stays. Only keys with several rows are aggregated.
    """
    winners = stored(winners, "winners")
    same = [F.col(k).eqNullSafe(F.col(f"_won_{k}")) for k in keys]
    won = winners.select(*[F.col(k).alias(f"_won_{k}") for k in keys], "_rows")
    found = docs.withColumns(keys)
    single = found.join(won.where("_rows = 1"), same, "left_semi").select(*docs.columns)
    if winners.where("_rows > 1").isEmpty():
        return single
    hashed = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    several = found.join(won.where("_rows > 1"), same, "left_semi").groupBy(*keys).agg(
        F.min_by(F.struct(*docs.columns), hashed).alias("_row"))
    return single.unionByName(several.select("_row.*"))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal keys (integers without null) of sorted batches, one table each."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        ends = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows]):
            key = tuple(values[:, a].tolist())
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def roots_of(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, for nodes 0 to n-1 and links left-right."""
    label = np.arange(n)
    while left.size:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            hop = label[label]
            if np.array_equal(hop, label):
                break
            label = hop
        if np.array_equal(before, label):
            break
        apart = label[left] != label[right]
        left, right = left[apart], right[apart]
    return label


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours likewise.
    Stars remain, in a number of rounds that grows with the logarithm of the
    number of nodes. Each round aggregates before it joins, joins large
    nodes by a split sort-merge join, and is written to the shared folder,
    so no round depends on an executor that may be lost.
    """
    def step(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges if not larger else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
        if larger:
            moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    state = None
    while True:
        edges = stored(step(step(edges, True), False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())
