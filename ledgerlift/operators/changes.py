"""Updates, merges and appends as new frames."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.picks import keyed_once, matching, summed, unmatched


def _joined(target: DataFrame, source: DataFrame, keys: dict[str, str], columns: Sequence[str], unique: bool) -> DataFrame:
    side = source.select(
        *(F.col(r).alias(f"_k_{l}") for l, r in keys.items()),
        *(F.col(c).alias(f"_s_{c}") for c in columns),
    )
    if not unique:
        side = keyed_once(side, [f"_k_{l}" for l in keys])
    return target.join(side.withColumn("_hit", F.lit(True)), [F.col(l) == F.col(f"_k_{l}") for l in keys], "left")


def merge_matched(
    target: DataFrame, source: DataFrame, keys: dict[str, str], sets: dict[str, str], unique: bool = False
) -> DataFrame:
    """Set columns of matched rows, also to NULL; leave unmatched rows alone.

    A key that ``source`` holds twice stops the job, unless its keys are ``unique`` by construction.
    """
    joined = _joined(target, source, keys, list(dict.fromkeys(sets.values())), unique)
    return joined.select(*(
        F.when(F.col("_hit"), F.col(f"_s_{sets[c]}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ))


def set_from(
    target: DataFrame, source: DataFrame, keys: dict[str, str], column: str, value: str, unique: bool = False
) -> DataFrame:
    """Set ``column`` on every row from ``source``, of at most one row per key; unmatched rows become NULL."""
    joined = _joined(target, source, keys, [value], unique)
    return joined.select(*(c for c in target.columns if c != column), F.col(f"_s_{value}").alias(column))


def set_from_where(
    target: DataFrame, source: DataFrame, keys: dict[str, str], column: str, value: str, where: Column, unique: bool = False
) -> DataFrame:
    """As :func:`set_from` on rows for which ``where`` is true; others keep their value."""
    joined = _joined(target, source, keys, [value], unique)
    new = F.when(where, F.col(f"_s_{value}")).otherwise(F.col(column))
    return joined.select(*(new.alias(c) if c == column else F.col(c) for c in target.columns))


def set_if_exists(target: DataFrame, source: DataFrame, keys: dict[str, str], sets: dict[str, Column]) -> DataFrame:
    """Set columns of rows whose key exists in ``source``."""
    known = summed(source, list(keys.values()), F.lit(True).alias("_known"))
    joined = _joined(target, known, keys, [], unique=True)
    return joined.select(*(
        F.when(F.col("_hit"), sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ))


def set_where(target: DataFrame, where: Column, sets: dict[str, Column]) -> DataFrame:
    """Set columns on rows for which ``where`` is true; right sides see old values."""
    return target.select(*(
        F.when(where, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ))


def absent_rows(new: DataFrame, existing: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (a NULL key never is)."""
    return unmatched(new, existing, keys)


def append_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` plus the rows of ``new`` it does not hold yet."""
    return existing.unionByName(absent_rows(new, existing, {k: k for k in keys}))


def without_slice(df: DataFrame, where: Column) -> DataFrame:
    """Rows for which ``where`` is false or NULL."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def replace_slice(df: DataFrame, new: DataFrame, where: Column) -> DataFrame:
    """Rows of the slice removed and ``new`` put in their place."""
    return without_slice(df, where).unionByName(new)


def drop_orphans(header: DataFrame, detail: DataFrame, on: dict[str, str]) -> DataFrame:
    """Headers that have at least one detail row."""
    return matching(header, detail, on)


def add_text_column(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast("string"))


def with_sentinel(df: DataFrame, row: Sequence) -> DataFrame:
    """``df`` plus one fixed row given in column order."""
    return df.unionByName(df.sparkSession.createDataFrame([tuple(row)], df.schema))
