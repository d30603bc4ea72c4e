"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should run with.  Shuffle partition count and executor
# sizes belong to the cluster's own configuration.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where a shuffled partition's build side is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  A local folder is set only in local mode, where
    neither that setting nor a checkpoint directory exists; on a cluster executors would not share it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


_loads: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; never reused."""
    path = f"{scratch_dir(spark).rstrip('/')}/ledgerlift/{label}-{uuid.uuid4().hex}"
    if _loads:
        _loads[-1].append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none where it is missing."""
    files, place = _file_system(spark, folder)
    return sorted(found.getPath().getName() for found in files.listStatus(place)) if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, seen by others whole or not at all; a path that is taken is an error."""
    files, place = _file_system(spark, path)
    draft = place.suffix(f".{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise RuntimeError(f"{path} is there already")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end; frames that read them are used up by then."""
    _loads.append([])
    try:
        yield
    finally:
        for path in _loads.pop():
            remove(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    A lost executor costs the lost tasks of the write, never the steps before
    it, and every later use sees the same rows in the same order of numbering.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def placed_joins(spark: SparkSession) -> Iterator[None]:
    """Frames written inside are joined without a shuffle where both sides are placed by a part of the keys already.

    Spark otherwise shuffles both sides by all keys, in case the part is skewed.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions of a shuffle before adaptive execution puts small ones together."""
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or shuffled)


def written_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """As :func:`written`, in as many buckets by ``key`` as a shuffle has partitions, and planned with :func:`placed_joins`.

    Joins and groups on keys that include ``key`` then need no shuffle of the table.  ``df`` should be placed by ``key``
    alone, so that each task writes its own buckets.  Where a later shuffle has another number of partitions, Spark
    shuffles the table as any other.  It is packed with zstd, as it is large and read few times.  It is an entry in the
    session's catalog.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    with placed_joins(spark):
        landing = df.write.format("parquet").option("path", path).option("compression", "zstd")
        landing.bucketBy(shuffle_partitions(spark), key).sortBy(key).saveAsTable(name)
    return spark.table(name)
