"""Rows of one key as one row with an array, for joins of streams whose keys hold many rows.

A stream-stream join looks into its state once per pair of rows. With packs it
looks once per pair of packs, and the pairs of rows come out of two arrays.
Packing keeps no state: a task packs what a micro-batch brings it, ``PACK_ROWS``
rows at a time, so a key may come as several packs and every row is in exactly one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

PACK_ROWS = 1 << 16


def packed(rows: DataFrame, keys: Sequence[str], newest: str, into: str) -> DataFrame:
    """``keys``, the largest ``newest`` of the pack, and the other columns of its rows as an array of structs ``into``."""
    keys = list(keys)
    others = [n for n in rows.columns if n not in (*keys, newest)]
    kinds = {field.name: StructField(field.name, field.dataType) for field in rows.schema.fields}
    schema = StructType([*[kinds[n] for n in (*keys, newest)], StructField(into, ArrayType(StructType([kinds[n] for n in others])))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            yield _pack(table, keys, newest, others, into)

    return rows.select(*keys, newest, *others).repartition(*keys).mapInArrow(pack, schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches together, up to about ``PACK_ROWS`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PACK_ROWS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _pack(table: pa.Table, keys: list[str], newest: str, others: list[str], into: str) -> pa.RecordBatch:
    groups = table.group_by(keys, use_threads=False).aggregate([(newest, "max"), *[(n, "list") for n in others]])
    lists = [groups[f"{n}_list"].combine_chunks() for n in others]
    rows = pa.ListArray.from_arrays(lists[0].offsets, pa.StructArray.from_arrays([c.values for c in lists], names=others))
    columns = [groups[n] for n in keys] + [groups[f"{newest}_max"], rows]
    return pa.Table.from_arrays(columns, names=[*keys, newest, into]).combine_chunks().to_batches()[0]


def pairs_of_packs(joined: DataFrame, keys: Sequence[str], left: str, right: str) -> DataFrame:
    """Every row of one array with every row of the other."""
    names = [field.name for field in joined.schema[left].dataType.elementType.fields]
    return joined.select(*keys, F.inline(left), right).select(*keys, *names, F.inline(right))
