"""Landed slices by year and the filters that read them."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.binding import PARAMS
from ledgerlift.functions import text as X
from ledgerlift.plans import fleet, modules, orders, quotes
from ledgerlift.session import scratch_path
from ledgerlift.sources import slices
from ledgerlift.sources.schema import SLICES
from tests.test_modules import sources

YEAR = replace(PARAMS, fiscal_year=1998)


def scan(df):
    """Text and number of files read of each scan of a sliced entity, without adaptive execution."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = df.select(*df.columns)
        frame.collect()
        leaves, found = frame._jdf.queryExecution().executedPlan().collectLeaves(), []
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if f"{slices.SLICE}#" in leaf.toString():
                found.append((leaf.toString(), leaf.metrics().apply("numFiles").value()))
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def landed(spark, folder):
    target = modules.Target(spark, scratch_path(spark, "slices"))
    found = sources(spark, folder)
    years = F.lit(1990) + F.col("number") % 12
    for name in SLICES:
        column = SLICES[name][0]
        if name == "inventory":
            years_of = F.lit(1990) + F.col("material") % 12
        else:
            years_of = years
        value = F.make_date(years_of.cast("int"), F.lit(3), F.lit(1)).cast("timestamp_ntz") if column == "issued" else years_of
        found[name] = found[name].withColumn(column, value)
    needed = {*SLICES, "quote_line", "order_line", "vehicle", "fuel_request_line", "stock_request_line", "movement_line"}
    return modules.checked({n: found[n] for n in needed}, target), found, target


def frames(s):
    return {
        "quote": quotes.quote_headers(s["quote"], s["quote_line"], YEAR),
        "purchase_order": slices.of_years(s["purchase_order"], "year", 1998, 1998),
        "fuel_request": slices.of_years(s["fuel_request"], "issued", 1998, 1998),
        "tender": slices.of_years(s["tender"], "year", 1998),
        "inventory": slices.of_years(s["inventory"], "year", 1997, 1997),
        "stock_request": slices.of_years(s["stock_request"], "year", 1998, 1998),
        "movement": slices.of_years(s["movement"], "year", 1998, 1998),
    }


@pytest.mark.parametrize("name", list(SLICES))
def test_only_slices_of_the_year_are_read(landed, name):
    good, raw, target = landed
    frame, whole = frames(good)[name], frames(raw)[name]
    assert slices.SLICE not in frame.columns
    assert frame.count() == whole.count() > 0
    (text, files), = scan(frame)
    assert slices.SLICE in text.split("PartitionFilters: [")[1].split("]")[0]
    (_, every), = scan(good[name])
    assert 0 < files <= every / (2 if name == "tender" else 4)


def test_final_plans_of_orders_and_fuel_have_partition_filters(landed):
    """The plans themselves, not only the filter: each scan of a sliced entity that reads a year is pruned."""
    good, _, _ = landed
    register = good["tender"].select(F.col("number").alias("tender"))
    centres = good["vehicle"].select(X.clean(fleet._plate()).alias("plate")).distinct().select(
        "plate", F.lit(1).cast("bigint").alias("centre"), F.lit("1").alias("store"))
    items = good["order_line"].select("material").distinct().withColumn("code", F.col("material").cast("string"))
    plans = {
        "purchase_order": orders.order_headers(good["purchase_order"], good["order_line"], register, YEAR),
        "fuel_request": fleet.fuelling(good["fuel_request"], good["fuel_request_line"], good["vehicle"], centres, items, YEAR)["headers"],
    }
    for df in plans.values():
        found = [(text, n) for text, n in scan(df) if "year:" in text.split("ReadSchema")[1] or "issued:" in text.split("ReadSchema")[1]]
        assert found and all(slices.SLICE in text.split("PartitionFilters: [")[1].split("]")[0] for text, _ in found)


def test_a_slice_has_few_files_in_key_order(spark, landed):
    _, _, target = landed
    path = target.path("landed/quote")
    files = spark.read.parquet(path).withColumn("f", F.input_file_name())
    assert files.groupBy("_fits", "_year").agg(F.count_distinct("f").alias("n")).agg(F.max("n")).first()[0] <= 4
    first = files.select("f").first()[0]
    own = [r.number for r in spark.read.parquet(first).select("number").collect()]
    assert own == sorted(own)


def test_stray_and_missing_years(spark, rows):
    df = spark.createDataFrame([(1, 2024), (2, None), (3, 99999), (4, -5), (5, 1900)], "k int, year long")
    cut = df.withColumn("_year", slices.slice_of(F.col("year"), T.LongType()))
    assert rows(cut.select("k", "_year")) == [(1, 2024), (2, None), (3, 2200), (4, 1900), (5, 1900)]
    for first, last in ((2024, 2024), (None, 1900), (2200, None), (-10, 0), (99999, 99999), (None, None)):
        assert rows(slices.of_years(cut, "year", first, last), "k") == rows(slices.of_years(df, "year", first, last), "k")
    days = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2024-12-31 23:59:59' AS d UNION ALL SELECT 2, TIMESTAMP_NTZ '2025-01-01 00:00:00' UNION ALL SELECT 3, NULL")
    assert rows(slices.of_years(days, "d", 2024, 2024), "k") == [(1,)]
    text = spark.createDataFrame([("2024",), ("x",), ("",)], "year string")
    assert rows(text.select(slices.slice_of(F.col("year"), T.LongType()).alias("y"))) == [(2024,), (None,), (None,)]
