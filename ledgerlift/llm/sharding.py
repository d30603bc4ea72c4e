"""Shards by vector bin packing: bytes, tokens and rows balanced together.

The unit is a group of equal texts.  A group with more than a set part of a shard's share of any
dimension is cut into slices by the hash of the document id, since no shard could hold it and stay
even.  Large units, whose number has a bound, are placed first and together; the others are dealt to
tasks by hash, and each task has its part of what room is left in every shard.  A unit goes, the
largest first, where its weighted dot product with the shard's residual capacity is highest.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.session import written

#: A unit is at most the first part of a shard's share, larger groups are cut; above the second it is large.
SLICE_OF_SHARE, LARGE_OF_SHARE = 1 / 2, 1 / 16
#: Weight of bytes, tokens and rows in the dot product; the law is that of the bytes.
WEIGHTS = np.array([10.0, 1.0, 1.0])
#: Units that one task places.
UNITS_PER_TASK = 200_000
#: Buckets in which the rows of a shard are counted, for slots without one task per shard.
SLOT_BUCKETS = 64

PLACED = "key string, slice int, shard int"
DIMENSIONS = ("bytes", "tokens", "rows")


def place(units: np.ndarray, capacity: np.ndarray, first: int = 0) -> np.ndarray:
    """Shard of every unit (rows of ``units``: bytes, tokens, rows), placed from the largest bytes on.

    ``capacity`` has a row for each shard; it may be negative where a shard is over-full.  Of equally good shards it is
    the next one from ``first`` on, so that tasks do not all favour the same.
    """
    shards = len(capacity)
    share = np.maximum(capacity.sum(0), 1) / shards
    residual = np.roll(capacity / share, -first, axis=0)
    load = units / share
    weighted = load * WEIGHTS
    out = np.zeros(len(units), np.int32)
    # A stable order: bytes, then the other dimensions, then the given order.
    for i in np.lexsort((np.arange(len(units)), -units[:, 2], -units[:, 1], -units[:, 0])):
        at = int(np.argmax(residual @ weighted[i]))
        out[i] = at
        residual[at] -= load[i]
    return (out + first) % shards


def _matrix(table: pa.Table) -> np.ndarray:
    return np.column_stack([table.column(c).to_numpy() for c in DIMENSIONS]).astype(np.float64)


def _placing(room: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        units = _matrix(table)
        part = room * (units.sum(0) / np.maximum(room.sum(0), 1))
        found = place(units, part, TaskContext.get().partitionId() * 11 % len(room))
        yield from table.select(["key", "slice"]).append_column("shard", pa.array(found, pa.int32())).to_batches(max_chunksize=10_000)

    return run


def shard(df: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    ``size`` is the text's UTF-8 bytes (null: none) plus ``overhead``.  The law is ``bytes``: sizes of the shards are
    near equal, so ``grown_shard`` is null.  ``slot`` numbers the rows of a shard from 0 without gaps.  A null text
    counts as an empty one; repeated rows are rows of their own.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(df.select(
        "doc_id", (F.octet_length(text) + overhead).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("key"),
        F.size(F.split(F.trim(text), r"\s+")).cast("bigint").alias("tokens")), "rows")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    share = {c: max(1.0, (total[c] or 0) / shards) for c in DIMENSIONS}
    groups = rows.groupBy("key").agg(*sums)
    # A single row is never cut.  The list has at most shards / SLICE_OF_SHARE rows a dimension.
    cuts = F.greatest(*[F.ceil(F.col(c) / F.lit(share[c] * SLICE_OF_SHARE)) for c in DIMENSIONS])
    cut = written(groups.withColumn("slices", F.least(cuts, F.col("rows")).cast("int")).filter("slices > 1").select("key", "slices"), "cut")
    sliced = rows.join(F.broadcast(cut), "key", "left").withColumn(
        "slice", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("slices").cast("bigint")), F.lit(0)).cast("int")).drop("slices")
    units = written(sliced.groupBy("key", "slice").agg(*sums), "units")
    is_large = F.greatest(*[F.col(c) / F.lit(share[c]) for c in DIMENSIONS]) > LARGE_OF_SHARE
    # At most shards / LARGE_OF_SHARE units a dimension.
    large = units.filter(is_large).orderBy("key", "slice").toArrow()
    room = np.tile([(total[c] or 0) / shards for c in DIMENSIONS], (shards, 1))
    found = place(_matrix(large), room) if large.num_rows else np.zeros(0, np.int32)
    if large.num_rows:
        np.subtract.at(room, found, _matrix(large))
    first = df.sparkSession.createDataFrame(
        [(k, s, int(h)) for k, s, h in zip(large.column("key").to_pylist(), large.column("slice").to_pylist(), found)], PLACED)
    small = units.filter(~is_large)
    tasks = max(1, -(-small.count() // UNITS_PER_TASK))
    dealt = small.repartition(tasks, "key", "slice") if tasks > 1 else small.coalesce(1)
    placed = written(dealt.sortWithinPartitions("key", "slice").mapInArrow(_placing(room), PLACED).union(first), "placed")
    rows = written(sliced.join(placed, ["key", "slice"]).select("doc_id", "size", "text_crc32", "shard", F.pmod(
        F.xxhash64("doc_id"), F.lit(SLOT_BUCKETS)).cast("int").alias("bucket")), "sharded")
    return numbered(rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def numbered(rows: DataFrame) -> DataFrame:
    """``slot`` from 0 within each shard: the rows of the buckets before, plus the place in the own bucket."""
    counts = rows.groupBy("shard", "bucket").count()  # shards * buckets rows
    before = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32"))
    return rows.withColumn("inner", inner).join(F.broadcast(before), ["shard", "bucket"]).withColumn(
        "slot", (F.col("before") + F.col("inner") - 1).cast("bigint"))
