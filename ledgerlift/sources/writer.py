"""Sinks: append, full refresh, slice refresh and relational load."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def refresh_slices(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def load_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000, connections: int = 8, **extra: str
) -> None:
    """Batched parallel load; ``overwrite`` empties the table and keeps its definition."""
    df.write.format("jdbc").mode(mode).options(
        url=url, dbtable=table, batchsize=batch_size, numPartitions=connections, truncate="true", **extra
    ).save()


def refresh_module(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Refresh the tables of a module in the order given (parents last to be read
    by children are written first)."""
    for name, df in frames.items():
        refresh(df, f"{folder.rstrip('/')}/{name}")
