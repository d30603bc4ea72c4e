"""Physical plans: what reaches the scan, what runs in one task, what is hinted."""

import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import load
from ledgerlift.operators import changes, lookups, picks

QUERIES, _ = load()
ROOT = Path(__file__).resolve().parent.parent


def plan(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, pushed", [
    ("filter_date_year", "GreaterThanOrEqual(l_shipdate"), ("fan_out_detail", "GreaterThanOrEqual(o_orderdate"),
    ("prior_balance", "LessThan(o_orderdate"),
])
def test_year_filter_reaches_the_scan(spark, folder, name, pushed):
    assert pushed in plan(spark, folder, name)


def test_scans_read_only_the_columns_in_use(spark, folder):
    text = plan(spark, folder, "agg_max")
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert schema.strip() == "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>"


@pytest.mark.parametrize("name", ["best_offer", "dedupe_latest", "fan_out_header", "amendment_price", "p_vehicles"])
def test_first_per_key_limits_before_the_shuffle(spark, folder, name):
    assert "WindowGroupLimit" in plan(spark, folder, name) and "Partial" in plan(spark, folder, name)


THRESHOLDS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}


@pytest.fixture
def skewed(spark, tmp_path):
    """Half of the rows under one key, on file in several parts, and thresholds at which that counts as skewed."""
    before = {k: spark.conf.get(k, None) for k in THRESHOLDS}
    for k, v in THRESHOLDS.items():
        spark.conf.set(k, v)
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    rows = spark.range(200_000).select(key.alias("k"), F.col("id").alias("line"), F.xxhash64("id").alias("v"))
    rows.repartition(8).write.parquet(str(tmp_path / "rows"))
    yield spark.read.parquet(str(tmp_path / "rows"))
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(df):
    frame = df.agg(F.bit_xor(F.xxhash64(*df.columns)))
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def once(df):
    """A side with one row for each key, which the operators check themselves."""
    return df.sparkSession.range(5000).select(F.col("id").alias("key"), F.col("id").alias("w"), F.col("id").cast("string").alias("name"))


@pytest.mark.parametrize("joined", [
    lambda df: picks.matching(df, df.filter("line % 3 = 0"), {"k": "k"}),
    lambda df: picks.unmatched(df, df.filter("k > 2500"), {"k": "k"}),
    lambda df: df.join(picks.summed(df.filter("line % 3 = 0"), ["k"], F.count("*").alias("n")), "k", "left"),
    lambda df: df.join(picks.summed(df, ["k"], F.sum("line").alias("s")), "k"),
    lambda df: df.join(picks.first_by(df, ["k"], ["line"], ["v"]).withColumnRenamed("v", "w"), "k"),
    lambda df: changes.set_if_exists(df, df.filter("line % 3 = 0"), {"k": "k"}, {"v": F.lit(0).cast("bigint")}),
    lambda df: lookups.lookup(df, once(df), {"k": "key"}, ["name"], "null"),
    lambda df: changes.merge_matched(df, once(df), {"k": "key"}, {"v": "w"}),
    lambda df: changes.set_from(df, once(df), {"k": "key"}, "v", "w"),
    lambda df: changes.set_from_where(df, once(df), {"k": "key"}, "v", "w", F.col("line") > 7),
], ids=["matching", "unmatched", "join_preagg", "join_composite", "first_by", "set_if_exists", "lookup", "merge_matched", "set_from", "set_from_where"])
def test_hot_keys_are_split(skewed, joined):
    assert "skew=true" in final_plan(joined(skewed))


def test_only_bounded_frames_are_hinted():
    """``broadcast`` is called in the numbering only, on a frame of one row per partition."""
    found = []
    for path in (ROOT / "ledgerlift").rglob("*.py"):
        if "llm" in path.parts:  # not a part of the library
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and node.attr in ("broadcast", "localCheckpoint", "toPandas", "rdd", "cache"):
                found.append((path.name, node.attr))
    assert sorted(found) == [("numbering.py", "broadcast")]


def test_offers_go_through_one_shuffle(spark, tmp_path):
    """Materials and tenders are looked up for the narrow items, and the offers meet these once."""
    from ledgerlift.plans import tenders

    kinds = {
        "offer": "tender long, material long, bidder long, line long, quantity double, unit_price double, total double, lowest int, offer date",
        "catalog": "number long", "item": "tender long, material long, annex string, failed string", "tender": "number long",
    }
    data = {
        "offer": [(t, m, 1, m, 2.0, 3.0, 6.0, 1, None) for t in (1, 2, None) for m in (5, 6, 7, None)] * 2,
        "catalog": [(5,), (6,), (6,), (None,)], "tender": [(1,), (1,), (None,)],
        "item": [(1, 5, "N", "S"), (1, 5, "N", None), (1, 6, "S", None), (1, 7, "N", None), (2, 5, "N", None), (None, 5, "N", None), (1, None, "N", None)],
    }
    frames = {}
    for name, kind in kinds.items():
        spark.createDataFrame(data[name], kind).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tenders.open_offers(frames["offer"], frames["catalog"], frames["item"], frames["tender"])
        text = found._jdf.queryExecution().executedPlan().toString()
        rows = found.select("tender", "material", "failed").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 5, "S"), (1, 5, None)] * 2, key=str)
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "unit_price" in line)
    depth, above = len(lines[at]) - len(lines[at].lstrip(" :+-")), 0
    for line in reversed(lines[:at]):  # the ancestors of the offers' scan
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth, above = here, above + ("Exchange hashpartitioning" in line)
    assert above == 1


def test_lookup_sides_carry_no_hash(spark, folder):
    """What places the groups of a lookup's side is a flag, which takes next to no room in a shuffle."""
    side = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
    for df in (picks.summed(side, ["k"], F.min("w").alias("w")), picks.keyed_once(side, ["k"])):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "xxhash64(" in text and text.count("xxhash64(") == text.count(", 42) = 0) AS ")
