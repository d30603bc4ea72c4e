"""Dimension lookups with a stated policy for missing keys.

No broadcast hint is given: Spark compares the dimension's size with
``spark.sql.autoBroadcastJoinThreshold`` and shuffles when it is larger.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.operators.picks import first_per_key, keyed_once, unmatched

MISS_POLICIES = ("fail", "null", "blank", "skip", "zero")


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    on: dict[str, str],
    values: Sequence[str],
    on_miss: str,
    unique: bool = False,
) -> DataFrame:
    """Add ``values`` of the dimension row whose key equals the row's key.

    ``fail`` stops the job at the first miss, ``null`` leaves NULL, ``blank``
    and ``zero`` put in a default, ``skip`` drops the row.  A key the dimension
    holds twice stops the job, unless its keys are ``unique`` by construction.
    """
    if on_miss not in MISS_POLICIES:
        raise ValueError(f"unknown miss policy: {on_miss}")
    dim = dimension.select(
        *(F.col(r).alias(f"_k_{l}") for l, r in on.items()),
        *values,
    )
    if not unique:
        dim = keyed_once(dim, [f"_k_{l}" for l in on])
    dim = dim.withColumn("_hit", F.lit(True))
    condition = [F.col(l) == F.col(f"_k_{l}") for l in on]
    joined = df.join(dim, condition, "inner" if on_miss == "skip" else "left")
    if on_miss == "fail":
        joined = found_or_fail(joined, F.col("_hit"), list(on), values)
    elif on_miss in ("blank", "zero"):
        default = F.lit("") if on_miss == "blank" else F.lit(0)
        joined = joined.withColumns({v: F.coalesce(F.col(v), default) for v in values})
    return joined.drop("_hit", *(f"_k_{l}" for l in on))


def found_or_fail(df: DataFrame, hit: Column, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df``, looked up by ``keys`` before: a row for which ``hit`` is not true stops the job where ``values`` are used."""
    shown = F.concat_ws(",", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys))
    error = F.raise_error(F.concat(F.lit(f"no {', '.join(values)} for {', '.join(keys)} = "), shown))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({v: F.when(hit, F.col(v)).otherwise(error.cast(kinds[v])) for v in values})


def misses(df: DataFrame, dimension: DataFrame, on: dict[str, str]) -> DataFrame:
    """Reject frame: rows the dimension does not know."""
    return unmatched(df, dimension, on, unique=True)


def unique_keys(dimension: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each key once: the first row in the stated order."""
    return first_per_key(dimension, keys, [F.col(c).asc_nulls_last() for c in order])


def duplicate_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Audit frame: keys held by more than one dimension row."""
    return dimension.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
