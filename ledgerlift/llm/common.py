"""Scratch tables, shipping of the package, links to components."""

import contextlib
import ctypes
import gc
import io
import os
import sys
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.session import written

#: Ids that may be broadcast at most (8 bytes each); beyond it, ids are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def ship(spark: SparkSession) -> None:
    """Send the package to Python workers that cannot import it from ``PYTHONPATH``."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_ledgerlift_sent", False):
        return
    import tempfile

    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for p in sorted(root.glob("ledgerlift/**/*.py")):
            out.write(p, p.relative_to(root))
    place = Path(tempfile.mkdtemp()) / "ledgerlift_llm.zip"
    place.write_bytes(packed.getvalue())
    before = list(sys.path)
    context.addPyFile(str(place))
    sys.path[:] = before  # the driver goes on with its own copy
    context._ledgerlift_sent = True


_holder: tuple[str, tuple[Callable[[], None], ...]] = ("", ())


def claim(operator: str, *releases: Callable[[], None]) -> None:
    """Called in a Python worker by each operator; what another one kept in the same worker is released first.

    Workers outlive a stage, and the word tables of one operator are of no use to the next.
    """
    global _holder
    if _holder[0] == operator:
        return
    for release in _holder[1]:
        release()
    _holder = operator, releases
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can give memory back
        ctypes.CDLL(None).malloc_trim(0)


def fold(column: str, parts: int) -> F.Column:
    """crc32 of the id's text (empty for a null id) modulo ``parts``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def checked(ids: DataFrame) -> DataFrame:
    """The written ``ids`` to broadcast if they are few, else as they are."""
    few = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    return F.broadcast(ids) if few else ids


def among(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the distinct ``ids``."""
    return df.join(checked(ids), column, "left_semi")


def without(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is null or not in the distinct ``ids``."""
    return df.join(checked(ids), column, "left_anti")


#: A key that holds more than this share of all rows is heavy; so at most ``HEAVY`` keys are.
HEAVY = 10_000


def by_heavy_keys(df: DataFrame, totals: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` left-joined with the written ``totals`` (one row of each ``key``, with its number ``n`` of rows in ``df``).

    ``rows`` is the number of rows of ``df``.  Rows of heavy keys, of which there are at most ``HEAVY``, meet a broadcast
    and stay where they are; those of all other keys are shuffled, of which none has more than a ``HEAVY``-th part.
    """
    heavy = F.broadcast(totals.filter(F.col("n") * HEAVY > rows).drop("n"))
    light = totals.filter(F.col("n") * HEAVY <= rows).drop("n")
    rest = df.join(heavy.select(key), key, "left_anti").join(light, key, "left")
    return rest.unionByName(df.join(heavy, key))


#: Edges that one task reduces to a forest.
FOREST_EDGES = 2_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges as stars: each node with the smallest it is connected to."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))  # nodes are sorted, so the smallest place is the smallest id
    while True:
        least = np.minimum(label[left], label[right])
        following = label.copy()
        # Hook the roots of both ends to the smaller root, then jump.
        np.minimum.at(following, label[left], least)
        np.minimum.at(following, label[right], least)
        while (jumped := following[following] != following).any():
            following = np.where(jumped, following[following], following)
        if (following == label).all():
            break
        label = following
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[label[linked]])], names=["a", "b"])


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, and none that has a smaller one itself."""
    twice = edges.groupBy("a").count().filter("count > 1")
    chained = edges.select("a").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a", F.lit(2).alias("count"))
    return twice.select("a", "count").union(chained).isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (smallest id reachable) of every id in ``edges`` (a, b) that has a neighbour.

    Tasks first reduce their edges to forests.  Then alternating large-star and small-star steps (Kiveris et al.
    2014) on written tables, until only stars are left.  Each step is an aggregation and a join, so that the edges
    of a node with many neighbours may be split.
    """
    found = written(edges.filter("a <> b").select("a", "b"), "links")
    tasks = max(1, found.count() // FOREST_EDGES)
    now = written(found.coalesce(tasks).mapInArrow(_forest, "a bigint, b bigint").distinct(), "edges")
    for _ in range(max_rounds):
        if _stars(now):
            break
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select("a", F.least("a", "m").alias("m")), "large")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "star")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "small")
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component")))


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of equal values in the first ``keys`` columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.column_stack([batch.column(i).to_numpy() for i in range(keys)])
        heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), batch.num_rows]):
            if held and tuple(key[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(key[a])
    if held:
        yield pa.Table.from_batches(held)
