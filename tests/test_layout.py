"""Tables along a space-filling curve: the key, all rows, and how much a box query reads."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from hopgrid.functions import geo
from hopgrid.sinks.tables import append_along_curve, trips_in_box


def interleaved(x, y):
    x, y = (v + (1 << 30) & (1 << 31) - 1 for v in (x, y))
    return sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(31))


def test_key(spark):
    pairs = [(0, 0), (-1482, 157880), (1, 0), (0, 1), (-1, -1), (720000, -360000), (2**30 - 1, -2**30)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {(r.a, r.b): r.k for r in frame.withColumn("k", geo.curve_key(F.col("a"), F.col("b"))).collect()}
    assert got == {p: interleaved(*p) for p in pairs}


def touched(path, low, high):
    """Row groups, and bytes of those, whose minima and maxima meet the box."""
    groups = size = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        places = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(places[c]).statistics for c in ("bin_0", "bin_1")]
            if all(s.max >= lo and s.min <= hi for s, lo, hi in zip(stats, low, high)):
                groups += 1
                size += meta.row_group(g).total_byte_size
    return groups, size


def test_a_box_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    rows = spark.range(n).select(F.col("id").alias("trip"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("bin_0"),
                                 F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("bin_1"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows = rows.unionByName(spark.range(50_000).selectExpr("id + 1000000 as trip", "5L as bin_0", "5L as bin_1", "'same' as text"))  # a hot bin
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "plain")
    append_along_curve(rows, curve, row_group_bytes=1 << 17)
    rows.repartition(4).write.option("parquet.block.size", 1 << 17).parquet(plain)
    low, high = (100, 200), (180, 280)
    few, all_ = touched(curve, low, high), touched(plain, low, high)
    assert few[0] * 5 < all_[0] and few[1] * 5 < all_[1]
    table = spark.read.parquet(curve)
    assert table.count() == n + 50_000
    box = trips_in_box(table, low, high)
    assert box.count() == trips_in_box(rows, low, high).count() > 0
    plan = box._sc._jvm.PythonSQLUtils.explainString(box._jdf.queryExecution(), "formatted")
    assert all(f"{op}({c},{v})" in plan for c, lo, hi in (("bin_0", 100, 180), ("bin_1", 200, 280))
               for op, v in (("GreaterThanOrEqual", lo), ("LessThanOrEqual", hi)))
