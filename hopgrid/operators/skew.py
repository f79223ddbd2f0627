"""Equi-joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hopgrid.config import SplitPolicy
from hopgrid.operators.packs import pairs_of_packs
from hopgrid.session import work_dir

LEFT_BLOCK, RIGHT_BLOCK = "_left_block", "_right_block"
LEFT_PACK, RIGHT_PACK = "_left_pack", "_right_pack"
GRID = ("left_parts", "right_parts")


def hot_keys(left: DataFrame, right: DataFrame | None, keys: list[str], policy: SplitPolicy) -> DataFrame:
    """Keys whose pairs should be shared by several tasks, with the grid size per side.

    ``right=None`` stands for a side with one row per key.
    """
    fraction = policy.sample_fraction
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
    if right is not None:
        sides = sides.unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    sides = sides.dropna(subset=keys)  # a missing key has no partner
    if fraction < 1.0:
        sides = sides.sample(fraction, seed=17)
    right_rows = F.sum("r") / fraction if right is not None else F.lit(1.0)
    return grid_of(sides.groupBy(*keys).agg((F.sum("l") / fraction).alias("l"), right_rows.alias("r")), keys, policy)


def grid_of(counts: DataFrame, keys: list[str], policy: SplitPolicy) -> DataFrame:
    """The crowded ones of counted keys (``l`` and ``r`` rows) with the grid size per side."""
    def parts(rows: str) -> Column:
        return F.greatest(F.ceil(F.col(rows) / policy.block_rows), F.lit(1)).cast("int")

    many_pairs = F.col("l") * F.col("r") > float(policy.block_rows) ** 2
    many_rows = F.greatest("l", "r") > policy.max_key_rows
    return counts.where(many_pairs | many_rows).select(
        *keys, parts("l").alias("left_parts"), parts("r").alias("right_parts"))


def grid_table(hot: DataFrame, policy: SplitPolicy) -> DataFrame | None:
    """The grid table, fixed once so both sides see the same one; None without hot keys."""
    spark = hot.sparkSession
    rows = hot.orderBy(F.desc("left_parts")).limit(policy.broadcast_keys + 1).collect()
    if not rows:
        return None
    if len(rows) <= policy.broadcast_keys:
        return F.broadcast(spark.createDataFrame(rows, hot.schema))
    path = work_dir(spark, "hot-keys")
    hot.write.parquet(path)
    return spark.read.parquet(path)


def _spread(side: DataFrame, own: Column, other: Column, own_block: str, other_block: str,
            spread: list[str]) -> DataFrame:
    """Give each row one of its side's blocks and a copy for each block of the other side.

    The block comes from the row's content, so a task that runs again puts the
    row in the same place.
    """
    place = F.pmod(F.xxhash64(*spread), own).cast("int")
    return side.withColumn(own_block, place).withColumn(
        other_block, F.explode(F.sequence(F.lit(0), other - 1)))


def split_sides(left: DataFrame, right: DataFrame, keys: list[str], policy: SplitPolicy,
                sized_by: tuple[DataFrame, DataFrame | None]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the keys to join them on; unchanged when no key is hot."""
    if not policy.enabled:
        return left, right, keys
    grid = grid_table(hot_keys(*sized_by, keys, policy), policy)
    if grid is None:
        return left, right, keys
    left_parts = F.coalesce("left_parts", F.lit(1))
    right_parts = F.coalesce("right_parts", F.lit(1))

    def with_grid(side: DataFrame) -> DataFrame:
        return side.join(grid, keys, "left")

    left_out = _spread(with_grid(left), left_parts, right_parts, LEFT_BLOCK, RIGHT_BLOCK, left.columns)
    right_out = _spread(with_grid(right), right_parts, left_parts, RIGHT_BLOCK, LEFT_BLOCK, right.columns)
    return left_out.drop(*GRID), right_out.drop(*GRID), [*keys, LEFT_BLOCK, RIGHT_BLOCK]


def fixed_split(left: DataFrame, right: DataFrame, keys: list[str], parts: int,
                crowded: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """A grid without counting: for streams, whose keys cannot be counted ahead, and for known crowded keys.

    Every key gets ``parts`` blocks per side; those in ``crowded``, a table of
    some of the key columns with ``left_parts`` and ``right_parts``, get theirs.
    A key that is crowded but not in the table costs balance, never rows.
    """
    if crowded is None and parts <= 1:
        return left, right, keys
    left_parts = right_parts = F.lit(parts)
    left_wide, right_wide = left, right
    if crowded is not None:
        on = [name for name in crowded.columns if name not in GRID]
        if not on or not set(on) <= set(keys):
            raise ValueError(f"crowded keys {on} are not among the join keys {keys}")
        left_wide, right_wide = left.join(crowded, on, "left"), right.join(crowded, on, "left")
        left_parts, right_parts = (F.coalesce(name, F.lit(parts)) for name in GRID)
    return (_spread(left_wide, left_parts, right_parts, LEFT_BLOCK, RIGHT_BLOCK, left.columns).drop(*GRID),
            _spread(right_wide, right_parts, left_parts, RIGHT_BLOCK, LEFT_BLOCK, right.columns).drop(*GRID),
            [*keys, LEFT_BLOCK, RIGHT_BLOCK])


def balanced_join(left: DataFrame, right: DataFrame, keys: list[str], policy: SplitPolicy,
                  condition: Column | None = None, *, stream_parts: int = 1,
                  crowded: DataFrame | None = None, semi: bool = False,
                  sized_by: tuple[DataFrame, DataFrame | None] | None = None,
                  pack: Callable[[DataFrame, list[str], str], DataFrame] | None = None) -> DataFrame:
    """Inner join on ``keys`` and ``condition``; every pair comes out exactly once.

    Column names other than the keys must differ between the sides. With
    ``semi`` the left columns of rows that have a partner are returned; a row of
    a split key may then come out once per block.

    ``crowded`` names the keys to cut, as ``fixed_split`` takes them; nothing is
    then counted, so building the join starts no job and reads no input.
    ``sized_by`` names cheaper frames with the same keys to count hot keys on,
    so that an aggregated side is not computed twice; None on the right stands
    for one row per key. ``pack`` turns a side of a stream into packs by the join
    keys, in the array column it is told; their pairs are unpacked after the join.
    """
    streaming = left.isStreaming or right.isStreaming
    if streaming or crowded is not None:
        left, right, on = fixed_split(left, right, keys, stream_parts if streaming else 1, crowded)
    else:
        left, right, on = split_sides(left, right, keys, policy, sized_by or (left, right))
    if not semi:
        if streaming and pack:
            packs = pack(left, on, LEFT_PACK).join(pack(right, on, RIGHT_PACK), on, "inner")
            joined = pairs_of_packs(packs, keys, LEFT_PACK, RIGHT_PACK)
        else:
            joined = left.join(right, on, "inner")
        joined = joined if condition is None else joined.where(condition)
        return joined.drop(LEFT_BLOCK, RIGHT_BLOCK)
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    full = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_right_{k}") for k in on])
    full = full if condition is None else full & condition
    return left.join(right, full, "left_semi").drop(LEFT_BLOCK, RIGHT_BLOCK)
