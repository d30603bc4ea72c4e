"""One row, or the tied best rows, per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``.

    Spark limits each key to one row per map task before the shuffle
    (WindowGroupLimit), so a key holding a third of the table sends one row
    per task, not a third of the table.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def best_with_ties(df: DataFrame, keys: Sequence[str], value: str, placed: bool = False) -> DataFrame:
    """Rows holding the highest ``value`` of their key, ties kept.

    Rows with a NULL key or value drop out.  The maximum is pre-aggregated and
    joined back on key and value, so the rows of a hot key never meet in one
    window task.  Where ``df`` is ``placed`` by some of the keys they have met
    already, and the maximum is taken in place, without a second shuffle.
    """
    if placed:
        top = F.max(value).over(Window.partitionBy(*keys))
        return df.dropna(subset=[*keys, value]).withColumn("_top", top).filter(F.col(value) == F.col("_top")).drop("_top")
    tops = df.groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(tops, [*keys, value], "left_semi")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys in which NULL equals NULL; right key columns are dropped."""
    other = right.select(
        *(F.col(k).alias(f"_r_{k}") for k in keys),
        *(c for c in right.columns if c not in keys),
    )
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_r_{k}" for k in keys))


def with_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows of the same key counted next to each row (pre-aggregated, joined back)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return null_safe(df, counts, keys, "inner")


def any_one(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the lowest, so that reruns agree."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def latest_value(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    """The value of the first row per key in ``order``."""
    return first_per_key(df, keys, order).select(*keys, value)


def summed(df: DataFrame, keys: Sequence[str], *totals: Column) -> DataFrame:
    """One row per key, for a join on the same keys.

    Grouped by the keys and a flag of their hash, so that the groups are not placed by the keys alone: the
    join then shuffles both sides itself, and adaptive execution may split a hot key of the other side.
    """
    return df.groupBy(*keys, _placed(keys)).agg(*totals).drop("_placed")


def _placed(keys: Sequence[str]) -> Column:
    """A flag that follows from the keys and is nearly always false, so that it adds next to nothing to a shuffle."""
    return (F.xxhash64(*keys) == 0).alias("_placed")


def keyed_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose keys may occur once, for a join on them: a second row of a key stops the job.

    Placed as by :func:`summed`, so that a hot key of the other side may still be split.  Rows with a NULL
    key, which match nothing, are left out.
    """
    values = [c for c in df.columns if c not in keys]
    known = df.dropna(subset=list(keys))
    once = known.groupBy(*keys, _placed(keys)).agg(
        F.count("*").alias("_rows"), *(F.first(v).alias(v) for v in values)
    )
    shown = F.concat_ws(",", *(F.col(k).cast("string") for k in keys))
    names = ", ".join(k.removeprefix("_k_") for k in keys)
    error = F.raise_error(F.concat(F.lit(f"more than one row for {names} = "), shown)).cast("boolean")
    return once.filter(F.when(F.col("_rows") == 1, F.lit(True)).otherwise(error)).select(*keys, *values)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``values`` of each key's first row in ascending ``order``, NULLs last, for a join on the same keys.

    An aggregation, combined before the shuffle and placed as by :func:`summed`: the join may split a hot key
    of the other side, which it could not beside :func:`first_per_key`.  Ties of ``order`` go to the lowest values.
    """
    rank = F.struct(*(part for c in (*order, *values) for part in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    best = summed(df, keys, F.min_by(F.struct(*values), rank).alias("_first"))
    return best.select(*keys, "_first.*")


def matching(df: DataFrame, other: DataFrame, on: dict[str, str], unique: bool = False) -> DataFrame:
    """Rows with a match in ``other``.

    Its keys are made distinct before the join, unless they are ``unique`` already, in a way
    that leaves a hot key of ``df`` to be split (see :func:`summed`).
    """
    return df.join(*_keys_of(other, on, unique), "left_semi")


def unmatched(df: DataFrame, other: DataFrame, on: dict[str, str], unique: bool = False) -> DataFrame:
    """Rows without a match in ``other``; a NULL key never matches and is kept."""
    return df.join(*_keys_of(other, on, unique), "left_anti")


def _keys_of(other: DataFrame, on: dict[str, str], unique: bool) -> tuple[DataFrame, list[Column]]:
    keys = other.select(*(F.col(r).alias(f"_k_{l}") for l, r in on.items()))
    if not unique:
        names = keys.columns
        keys = summed(keys, names, F.lit(True).alias("_known")).select(*names)
    return keys, [F.col(l) == F.col(f"_k_{l}") for l in on]
