"""Exact deduplication over an extendible-hash index (SQL functions only).

Texts count as equal when they are identical after each run of white space
(space, tab to carriage return) became one space.

1. ``hash_probes``: key (64-bit hash), digest and id of every row, stored.
2. ``directory``: distinct keys per hash prefix. Starting from one bucket, the
   directory doubles and every overfull bucket splits by one more bit, until
   all hold at most ``BUCKET_ENTRIES`` keys or are ``MAX_DEPTH`` bits deep. It
   grows with the input up to 2**MAX_DEPTH slots and never beyond.
3. ``map_entries``: copies meet in the map tasks and once more in ``SPREAD``
   parts, so of a text that a third of all rows share few rows with its bytes
   are left, but which texts are equal is not decided yet.
4. ``build_index``: the directory routes entries, bytes included, to the bucket
   they belong to, a range of keys that one owner task holds. There entries
   with the same key are compared byte by byte: equal ones become one, with the
   smallest id and the number of copies, the others are chained (``chain``:
   place in the chain). The index is stored in the shared folder.
5. ``exact_duplicates``: every row finds its bucket in the directory, its key in
   the bucket and its text in the chain. Entries with more than a
   ``HOT_ENTRIES``-th of all rows (so fewer than ``HOT_ENTRIES`` of them) are
   broadcast: their rows stay where they are.

Null texts count as empty; empty texts are equal to each other. Exactly one row
of each group stays: the one with the smallest id, rows without an id last (a
group of only such rows has a null ``keep_id``). Of rows that repeat the id and
the text one stays as well: the first read, or in ``drop_exact_duplicates`` the
one with the smallest hash over its columns. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hopgrid.llm.common import one_of_each, stored, text_or_empty

MAX_DEPTH = 20         # the directory never has more than 2**20 slots
BUCKET_ENTRIES = 4096  # keys that a bucket holds before it splits
SPREAD = 32            # parts in which the copies of one text are gathered first
HOT_ENTRIES = 4096     # entries with more than this share of the rows are broadcast


def normalised(name: str = "text") -> Column:
    # Single spaces are already right; only other runs are rewritten.
    return F.regexp_replace(text_or_empty(name), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def key_of(norm: str) -> Column:
    return F.xxhash64(norm)


def digest_of(norm: str) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _slot(key: str) -> Column:
    """The first ``MAX_DEPTH`` bits of a 64-bit key."""
    return F.shiftrightunsigned(F.col(key), 64 - MAX_DEPTH).cast("int")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), normalised(text).alias("norm")).withColumn("key", key_of("norm"))


def hash_probes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored: id, key, digest and row (unique) of every row."""
    return stored(_rows(docs, doc_id, text).select("id", "key", digest_of("norm").alias("digest"),
                                                   F.monotonically_increasing_id().alias("row")), "hash-probes")


def map_entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Entries before the index: key, norm, least_id, copies; a text may have up to ``SPREAD`` of them."""
    parts = _rows(docs, doc_id, text).withColumn("part", F.spark_partition_id() % SPREAD)
    return (parts.groupBy("part", "key", "norm").agg(F.min("id").alias("least_id"), F.count("*").alias("copies"))
            .drop("part"))


def directory(entries: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The slots with the bucket each belongs to: slot, depth, bucket (slot and bucket as MAX_DEPTH bits).

    A bucket's depth is the smallest one at which its prefix holds no more than
    ``capacity`` different keys: what splitting overfull buckets bit by bit ends
    with. Buckets that are still overfull at MAX_DEPTH stay as they are. There are
    2**(depth of the deepest bucket) slots, less those of prefixes without a key.
    """
    counts = entries.select("key").distinct().groupBy(_slot("key").alias("slot")).agg(F.count("*").alias("n"))
    spread = counts.select("n", "slot", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth"))
    sizes = spread.groupBy("depth", F.expr(f"shiftrightunsigned(slot, {MAX_DEPTH} - depth)").alias("prefix")).agg(F.sum("n").alias("size"))
    overfull = (F.col("size") > capacity) & (F.col("depth") < MAX_DEPTH)
    # A split prefix has two children, so no key of this join has more than two rows.
    split = sizes.where(overfull).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fits = sizes.where(~overfull).withColumn("parent", F.shiftright("prefix", 1))
    buckets = stored(fits.where("depth = 0").unionByName(fits.join(split, ["depth", "parent"], "left_semi").select(fits.columns)).select(
        "depth", F.expr(f"shiftleft(prefix, {MAX_DEPTH} - depth)").alias("bucket")), "hash-buckets")
    deepest = _deepest(buckets)
    steps = F.explode(F.expr(f"sequence(0, shiftleft(1, {deepest} - depth) - 1)")).alias("step")
    return buckets.select("depth", "bucket", steps).select(
        F.expr(f"bucket + shiftleft(step, {MAX_DEPTH - deepest})").alias("slot"), "depth", "bucket")


def _deepest(buckets: DataFrame) -> int:
    return buckets.agg(F.max("depth")).first()[0] or 0


def _in_buckets(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` with the bucket and depth the directory (at most 2**MAX_DEPTH rows) has for their keys."""
    unused = MAX_DEPTH - _deepest(slots)
    slot = F.shiftleft(F.shiftright(_slot("key"), unused), unused)
    return rows.withColumn("slot", slot).join(F.broadcast(slots), "slot").drop("slot")


def build_index(entries: DataFrame, slots: DataFrame) -> DataFrame:
    """The stored index: bucket, depth, key, chain, digest, keep_id, group_size."""
    owned = _in_buckets(entries, slots).repartition("bucket")
    # Both steps keep to the owner's partition: rows of a bucket do not move again.
    texts = owned.groupBy("bucket", "depth", "key", "norm").agg(
        F.min("least_id").alias("keep_id"), F.sum("copies").alias("group_size")).withColumn("digest", digest_of("norm")).drop("norm")
    place = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("digest")) - 1
    return stored(texts.select("bucket", "depth", "key", place.alias("chain"), "digest", "keep_id", "group_size"), "hash-index")


def _indexed(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Probes with their buckets, and the index."""
    probes = hash_probes(docs, doc_id, text)
    slots = stored(directory(probes), "hash-directory")
    return _in_buckets(probes, slots), build_index(map_entries(docs, doc_id, text), slots)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    probes, index = _indexed(docs, doc_id, text)
    place = ["bucket", "key", "digest"]
    first = probes.groupBy(*place).agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).getField("row").alias("first"))
    entries = stored(index.select(*place, "keep_id", "group_size").join(first, place), "hash-entries")
    total = entries.agg(F.sum("group_size")).first()[0] or 0
    hot = F.col("group_size") * HOT_ENTRIES > total
    crowded = F.broadcast(entries.where(hot))  # fewer than HOT_ENTRIES rows
    found = probes.join(crowded, place).unionByName(
        probes.join(crowded.select(*place), place, "left_anti").join(entries.where(~hot), place))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each distinct text, with all its columns."""
    probes, index = _indexed(docs, doc_id, text)
    kept = index.select(F.col("bucket").alias("_bucket"), F.col("key").alias("_key"), F.col("digest").alias("_digest"), F.col("keep_id").alias("_id"))
    # How many rows have the text and the id that stays: mostly one.
    rows = probes.groupBy("bucket", "key", "digest", "id").agg(F.count("*").alias("_rows"))
    winners = kept.join(rows, (F.col("_bucket") == F.col("bucket")) & (F.col("_key") == F.col("key"))
                        & (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("id")))
    norm = normalised(text)
    keys = {"_id": F.col(doc_id).cast("long"), "_key": key_of(norm), "_digest": digest_of(norm)}
    return one_of_each(docs, keys, winners.select(*keys, "_rows"))
