from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlift.operators import numbering as N
from ledgerlift.sources.reader import read_table

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def lines(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return read_table(spark, folder, "lineitem").select(*keys, "l_returnflag"), [F.col(k).asc_nulls_last() for k in keys]


def differing(a, b):
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def test_number_all_equals_plain_window(spark, folder):
    df, order = lines(spark, folder)
    order = [F.col("l_shipdate").desc_nulls_first(), *order]
    plain = df.withColumn("n", (F.row_number().over(Window.orderBy(*order)) + 7).cast("bigint"))
    assert differing(N.number_all(df, order, "n", start=7).select(plain.columns), plain) == 0


def test_number_within_equals_plain_window(spark, folder):
    df, order = lines(spark, folder)
    # one key holds two thirds of the rows, one is NULL
    df = df.withColumn("k", F.when(F.col("l_returnflag") == "N", None).when(F.col("l_suppkey") < 9, F.lit(1)).otherwise(F.col("l_suppkey")))
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    found = N.number_within(df, ["k"], order, "n")
    assert found.count() == df.count()
    assert differing(found.select(plain.columns), plain) == 0


def test_split_numbering_carries_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.when(F.col("id") < 4900, 1).otherwise(2).alias("k"), (5000 - F.col("id")).alias("v"))
        found = N.number_within(df, ["k"], [F.col("v").asc()], "n")
        plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v")).cast("bigint"))
        assert differing(found.select(plain.columns), plain) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_dense_ranks(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 9), ("b", 1), (None, 2)], "k string, v int")
    assert rows(N.rank_within(df, ["k"], ["v"], "n"), "k", "v", "n") == [
        ("a", 5, 1), ("a", 5, 1), ("a", 9, 2), ("b", 1, 1), (None, 2, 1)
    ]
    assert rows(N.rank_all(df, ["k", "v"], "n"), "n") == [(1,), (1,), (2,), (3,), (4,)]


def test_numbers_continue_after_existing(spark, rows):
    old = spark.createDataFrame([(4,), (9,)], "id bigint")
    new = spark.createDataFrame([(date(2020, 1, 2),), (date(2020, 1, 1),)], "d date")
    assert rows(N.continue_numbers(old, "id", new, [F.col("d").asc()]), "d", "id") == [
        (date(2020, 1, 1), 10), (date(2020, 1, 2), 11)
    ]
    assert N.highest(old.limit(0), "id") == 0


def counter_codes(count, size):
    """The counter that a loader keeps per group: past size-1 it moves to the next block and restarts at 0."""
    block, serial, out = 0, 0, []
    for _ in range(count):
        serial += 1
        if serial > size - 1:
            block, serial = block + 1, 0
        out.append((block, serial))
    return out


@SLOW
@given(st.lists(st.integers(1, 45), min_size=1, max_size=4), st.integers(2, 12))
def test_block_codes_equal_the_counter(spark, sizes, size):
    data = [(f"g{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(data, "g string, i int")
    found = {(r.g, r.i): (r.block, r.serial) for r in N.block_codes(df, ["g"], [F.col("i").asc()], size).collect()}
    for g, n in enumerate(sizes):
        assert [found[(f"g{g}", i)] for i in range(n)] == counter_codes(n, size)


def test_full_groups_open_new_ones(spark, rows):
    df = spark.createDataFrame(
        [("big", i) for i in range(2001)] + [("fit", i) for i in range(999)] + [("one", i) for i in range(1000)],
        "g string, i int",
    )
    coded = N.block_codes(df, ["g"], [F.col("i").asc()], 1000)
    assert rows(coded.groupBy("g", "block").agg(F.count("*").alias("n"), F.min("serial").alias("lo"), F.max("serial").alias("hi"))) == [
        ("big", 0, 999, 1, 999), ("big", 1, 1000, 0, 999), ("big", 2, 2, 0, 1), ("fit", 0, 999, 1, 999),
        ("one", 0, 999, 1, 999), ("one", 1, 1, 0, 0),
    ]
    assert rows(N.block_groups(coded, ["g"], 40, "sub"), "g", "block", "sub") == [("big", 1, 41), ("big", 2, 42), ("one", 1, 43)]
