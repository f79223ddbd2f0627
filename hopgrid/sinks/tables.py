"""Appending to tables and topics, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hopgrid.functions import geo

# Lets a lookup by trip id skip row groups; ids are random, so min/max would not.
BLOOM = {"parquet.bloom.filter.enabled#trip_id": "true"}


def append_table(rows: DataFrame, path: str, columns: tuple[str, ...] | None = None,
                 partition_by: tuple[str, ...] = ()) -> None:
    """Append to the parquet table at ``path``, which is created if needed."""
    writer = _projected(rows, columns, partition_by).write.mode("append")
    if "trip_id" in rows.columns:
        writer = writer.options(**BLOOM)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_once(rows: DataFrame, path: str, job: str, columns: tuple[str, ...] | None = None) -> None:
    """Append under the name of a job: run again, it replaces its own rows and adds none.

    Each job has a folder of its own in the table, which Spark's committer fills
    in one step after all tasks are done; readers get the name as column ``job``.
    """
    if not job or any(c in job for c in "/\\=%:"):
        raise ValueError(f"not a name for a job: {job!r}")
    writer = _projected(rows, columns, ()).write.mode("overwrite")
    if "trip_id" in rows.columns:
        writer = writer.options(**BLOOM)
    writer.parquet(f"{path.rstrip('/')}/job={job}")


def append_along_curve(rows: DataFrame, path: str, bins: tuple[str, str] = ("bin_0", "bin_1"), columns: tuple[str, ...] | None = None,
                       row_group_bytes: int | None = None) -> None:
    """Append with rows that are near on the map in the same files and row groups.

    Rows are dealt out by ranges of the key of a space-filling curve over two bin
    columns and sorted by it, so a filter on a box of bins reads few row groups:
    their minima and maxima are narrow in both axes. A bin with very many rows
    is spread over tasks by a hash of the row.
    """
    kept = _projected(rows, columns, ())
    order = [geo.curve_key(F.col(bins[0]), F.col(bins[1])), F.xxhash64(*[c for c, kind in kept.dtypes if "map<" not in kind])]
    writer = kept.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def trips_in_box(trips: DataFrame, low: tuple[int, int], high: tuple[int, int], bins: tuple[str, str] = ("bin_0", "bin_1")) -> DataFrame:
    """Rows of a table with bin columns that lie in a box of bins, borders included; both ranges reach the scan."""
    return trips.where(F.col(bins[0]).between(low[0], high[0]) & F.col(bins[1]).between(low[1], high[1]))


def append_stream(rows: DataFrame, path: str, checkpoint: str, columns: tuple[str, ...] | None = None,
                  partition_by: tuple[str, ...] = (), trigger: dict | None = None,
                  name: str | None = None) -> StreamingQuery:
    """Append a stream to the parquet table at ``path``, each row once."""
    writer = (_projected(rows, columns, partition_by).writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if "trip_id" in rows.columns:
        writer = writer.options(**BLOOM)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "15 seconds"})).start()


def send_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery | None:
    """Send ``value`` (and ``key``) to a topic; a stream needs its ``checkpoint``."""
    if not messages.isStreaming:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        return None
    return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def send_to_files(messages: DataFrame, path: str, checkpoint: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery | None:
    """The same into text files, one message per line."""
    values = messages.select("value")
    if not messages.isStreaming:
        values.write.mode("append").text(path)
        return None
    return (values.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def _projected(rows: DataFrame, columns: tuple[str, ...] | None, partition_by: tuple[str, ...]) -> DataFrame:
    if not columns:
        return rows
    return rows.select(*columns, *[name for name in partition_by if name not in columns])
