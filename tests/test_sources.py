import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.binding import Entities
from checks.registry import Tables
from ledgerlift.plans import modules
from ledgerlift.session import scratch_dir, scratch_path, written
from ledgerlift.sources import reader, writer
from ledgerlift.sources.schema import ENTITIES, contract


def test_contract_splits_good_and_bad_rows(spark, rows):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("4", None)], "id string, name string")
    good, bad = reader.conform(df, T.StructType.fromDDL("id bigint NOT NULL, name string"))
    assert rows(good) == [(1, "a"), (4, None)] and rows(bad, "name") == [("b",), ("c",)]
    assert good.schema["id"].dataType == T.LongType()
    with pytest.raises(reader.ContractError, match="other"):
        reader.conform(df, T.StructType.fromDDL("other int"))


def test_contract_rejects_what_a_cast_would_change(spark, rows):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 1.0D, 12.34D, TIMESTAMP'2024-01-02 00:00:00'), (2, 1.7D, 1D, NULL), (3, 2D, 12.345D, NULL),
        (4, 2D, 1D, TIMESTAMP'2024-01-02 10:30:00'), (5, NULL, NULL, NULL) AS t(nr, whole, money, day)""")
    good, bad = reader.conform(df, T.StructType.fromDDL("nr int NOT NULL, whole bigint, money decimal(18,2), day date"))
    assert rows(good, "nr") == [(1,), (5,)] and rows(bad, "nr") == [(2,), (3,), (4,)]


def test_rejected_rows_are_written(spark, rows, tmp_path):
    kind = "number double, name string"
    df = spark.createDataFrame([(1.0, "a"), (1.7, "b"), (None, "c")], kind)
    target = modules.Target(spark, str(tmp_path))
    assert rows(modules.checked({"store": df}, target)["store"]) == [(1, "a")]
    assert rows(target.read("rejected/store"), "name") == [("b",), ("c",)]


def test_bound_entities_fit_their_contracts(spark, folder):
    e = Entities(Tables(spark, folder))
    for name in set(ENTITIES) - {"vehicle_make"}:
        frame = getattr(e, name)
        fields = {f.name: f.dataType for f in frame.schema.fields}
        assert {f.name: f.dataType for f in contract(name).fields} == fields, name


def test_empty_text_is_null_on_relational_reads(spark, rows):
    df = spark.createDataFrame([("", 1), ("x", 2)], "t string, n int")
    assert rows(reader.empty_as_null(df)) == [("x", 2), (None, 1)]


def test_relational_options():
    split = reader.jdbc_options("jdbc:x", table="t", split_by="id", bounds=(1, 900), splits=9)
    assert (split["dbtable"], split["partitionColumn"], split["numPartitions"], split["upperBound"]) == ("t", "id", "9", "900")
    assert reader.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    for wrong in ({}, {"table": "t", "query": "q"}, {"query": "q", "split_by": "id", "bounds": (1, 2)}, {"table": "t", "split_by": "id"}):
        with pytest.raises(ValueError):
            reader.jdbc_options("jdbc:x", **wrong)


def test_append_refresh_and_slices(spark, rows):
    path = scratch_path(spark, "sink")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "part string, v int")
    writer.append(first, path, ["part"])
    writer.append(first, path, ["part"])
    assert spark.read.parquet(path).count() == 4
    writer.refresh(first, path, ["part"])
    assert spark.read.parquet(path).count() == 2
    writer.refresh_slices(spark.createDataFrame([("b", 9)], "part string, v int"), path, ["part"])
    assert rows(spark.read.parquet(path), "part", "v") == [("a", 1), ("b", 9)]


def test_scratch_folder_follows_the_cluster_setting(spark):
    assert scratch_dir(spark) == scratch_dir(spark)

    class Cluster:
        conf = {"spark.checkpoint.dir": "hdfs://shared/run/"}

    assert scratch_path(Cluster(), "x").startswith("hdfs://shared/run/ledgerlift/x-")


@pytest.mark.parametrize("master", ["yarn", "k8s://x", "spark://x", "local-cluster[2,1,1024]"])
def test_a_cluster_without_shared_folder_is_an_error(master):
    class Context:
        def getCheckpointDir(self):
            return None

    class Cluster:
        conf = {}
        sparkContext = Context()

    Context.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster())


def test_written_cuts_lineage(spark):
    df = written(spark.range(10).withColumn("v", F.col("id") * 2), "cut")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan and df.count() == 10


@pytest.mark.parametrize("kind, good, bad", [
    ("decimal(10,2)", ["12.34", "-0.5", "+7", "12.3400", ".5", "1e2", " 3.1 "], ["12.345", "1e-3", "x", "99999999999"]),
    ("date", ["2024-01-01", "2024-01-01 00:00:00", "2024-1-2"], ["2024-01-01 10:11:12", "2024-02-30", "2024", "soon"]),
    ("bigint", ["12", "-3", "007", "4.0"], ["4.5", "1e3", "9999999999999999999"]),
    ("double", ["1.5", "-2e10", "0.1", "123456789012345", "1000000000000000000000"], ["1234567890.1234567890", "abc"]),
    ("timestamp_ntz", ["2024-01-01 10:11:12.123456", "2024-01-01", "2024-01-01T10:11"], ["2024-01-01 10:11:12.1234567", "2024-01-01 10:11:12+02:00", "10 o'clock"]),
    ("string", ["", " x ", "12.345"], []),
])
def test_text_is_loaded_without_loss(spark, rows, kind, good, bad):
    """What a text says beyond its target type does not vanish: the row is rejected."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*good, *bad, None])], "k int, v string")
    fit, rest = reader.conform(df, T.StructType.fromDDL(f"k int, v {kind}"))
    assert rows(fit, "k") == [(i,) for i in range(len(good))] + [(len(good) + len(bad),)]
    assert rows(rest, "k") == [(i,) for i in range(len(good), len(good) + len(bad))]
