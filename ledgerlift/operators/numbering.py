"""Consecutive numbers over whole tables and within groups.

A plain ``row_number`` puts a whole table, or a whole group, into one task.
Here rows are range-partitioned by the full sort order, which ends with a
unique key, so no value can fill a partition; each partition numbers its own
rows and is shifted by the rows before it.  The placed rows are written to the
shared folder first, because range bounds come from a sample and every use must
see the same placement; so these functions run jobs while the plan is built.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlift.operators.picks import null_safe
from ledgerlift.session import written


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows with the partition and position they have in the global sort order."""
    spot = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_spot", spot)
    # The id holds the partition number above bit 33 and the position below it.
    return (
        written(ranged, "placed")
        .withColumn("_part", F.shiftright("_spot", 33))
        .withColumn("_pos", F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_spot")
    )


def _offsets(sizes: DataFrame) -> DataFrame:
    """(_part, _before): rows in the partitions before each, from their ``n`` in ``sizes``.

    One row per partition meets in a task and is broadcast: a bound set by the cluster, not the data.
    """
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")))


def number_all(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers ``start + 1 …`` over the whole table in ``order``."""
    placed = _placed(df, order)
    offsets = _offsets(placed.groupBy("_part").agg(F.count("*").alias("n")))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.lit(start) + F.col("_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before")
    )


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Consecutive numbers from 1 within each key (NULL keys form one group).

    A row's number is its position in the order of keys and ``order`` over the whole table less the position
    of the first row of its key, both from one range-split table.  Where each key begins is one aggregation,
    combined before its shuffle, and a join that may split a hot key; where there are few keys the join needs
    no shuffle of the rows.  So every group, of any size, goes the same path.  The rows go through scratch:
    callers pass key and sort columns only and join the numbers back.
    """
    placed = _placed(df, [*(F.col(k).asc() for k in keys), *order])
    spans = written(placed.groupBy("_part", *keys).agg(F.count("*").alias("n"), F.min("_pos").alias("_pos")), "spans")
    offsets = _offsets(spans.groupBy("_part").agg(F.sum("n").alias("n")))
    spot = F.col("_before") + F.col("_pos")
    begins = spans.join(offsets, "_part").groupBy(*keys).agg(F.min(spot).alias("_first"))
    return (
        null_safe(placed.join(offsets, "_part"), begins, keys, "inner")
        .withColumn(name, (spot - F.col("_first") + 1).cast("bigint"))
        .drop("_part", "_pos", "_before", "_first")
    )


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
) -> DataFrame:
    """Dense rank of the ``order`` columns (ascending) within each key."""
    columns = [*keys, *order]
    ranked = number_within(
        df.select(*columns).distinct(), keys, [F.col(c).asc_nulls_last() for c in order], name
    )
    return null_safe(df, ranked, columns, "inner")


def rank_all(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Dense rank over the whole table: numbered distinct keys, joined back."""
    ranked = number_all(
        df.select(*order).distinct(), [F.col(c).asc_nulls_last() for c in order], name, start
    )
    return null_safe(df, ranked, list(order), "inner")


def highest(df: DataFrame, column: str) -> int:
    """Highest number in use, 0 for an empty table (one value reaches the driver)."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("top")).first()["top"]


def continue_numbers(existing: DataFrame, column: str, new: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``new`` with numbers in ``column`` that continue after those in ``existing``."""
    return number_all(new, order, column, start=highest(existing, column))


def anew(
    register: str, rows: DataFrame, keys: Sequence[str], order: Sequence[Column], within: Sequence[str] = (), start: int = 0
) -> DataFrame:
    """``rows`` with numbers ``n`` in ``order``, after ``start`` or from 1 within the columns ``within``.

    What plans number by where no register keeps the numbers given before (see :func:`kept`).
    """
    return number_within(rows, within, order, "n") if within else number_all(rows, order, "n", start)


def kept(
    given: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column], within: Sequence[str] = (), start: int = 0
) -> DataFrame:
    """Numbers ``n`` of the ``keys`` of ``rows`` that the register ``given`` (keys, n) lacks.

    They go on in ``order`` after the highest number given, or the highest within the columns ``within``, which are
    among the keys, and after ``start``.  A key of several rows has one number, in the order of their lowest values.
    """
    others = [c for c in rows.columns if c not in keys]
    once = rows.groupBy(*keys).agg(*(F.min(c).alias(c) for c in others)) if others else rows.distinct()
    fresh = null_safe(once, given.select(*keys), keys, "left_anti")
    if not within:
        return number_all(fresh, order, "n", max(start, highest(given, "n"))).select(*keys, "n")
    tops = given.groupBy(*within).agg(F.max("n").alias("_top"))
    after = null_safe(number_within(fresh, within, order, "n"), tops, within, "left")
    return after.select(*keys, (F.col("n") + F.coalesce("_top", F.lit(0))).alias("n"))


def blocked(numbered: DataFrame, name: str, block_size: int) -> DataFrame:
    """``block`` and ``serial`` for the number ``name`` of an item in its group: quotient and remainder."""
    return (
        numbered.withColumn("block", F.floor(F.col(name) / block_size).cast("bigint"))
        .withColumn("serial", F.col(name) % block_size)
        .drop(name)
    )


def block_codes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block_size: int,
) -> DataFrame:
    """Item ``serial`` within ``block``: the first block holds 1 … size-1, later
    blocks 0 … size-1, so serial and block are remainder and quotient of the
    item's number in its group."""
    return blocked(number_within(df, keys, order, "_rn"), "_rn", block_size)


def block_groups(coded: DataFrame, keys: Sequence[str], start: int, name: str) -> DataFrame:
    """One new group number per (key, block) opened beyond the first block,
    counted on from ``start`` in key and block order."""
    opened = coded.filter("block > 0").select(*keys, "block").distinct()
    return number_all(opened, [F.col(c) for c in (*keys, "block")], name, start)
