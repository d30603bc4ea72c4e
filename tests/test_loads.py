"""Numbers kept from load to load, and loads that fail on the way."""

import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import numbering
from ledgerlift.plans import modules
from ledgerlift.session import exists, scratch_path


@pytest.fixture
def target(spark):
    return modules.Target(spark, scratch_path(spark, "loads"))


def test_numbers_given_once_stay(spark, rows, target):
    """New keys, also those in front of all others, take the next numbers; a key that went and comes back has its old one."""
    def given(*names):
        df = spark.createDataFrame([(n,) for n in names], "k string")
        return dict(rows(target.numbers("r", df, ["k"], [F.col("k").asc_nulls_last()]), "k", "n"))

    assert given("b", "d", None) == {"b": 1, "d": 2, None: 3}
    assert given("a", "b", "d", None) == {"a": 4, "b": 1, "d": 2, None: 3}
    assert given("c") == {"c": 5}
    assert given("b", "c", "e") == {"b": 1, "c": 5, "e": 6}
    assert given() == {}
    again = modules.Target(spark, target.folder)
    assert rows(again.read("registers/r").select("n")) == [(i,) for i in range(1, 7)]


def test_numbers_within_groups_and_after_a_start(spark, rows, target):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "g int, k string")
    more = df.union(spark.createDataFrame([(1, "a"), (3, "q"), (2, "b")], df.schema))

    def within(rows_):
        return target.numbers("g", rows_, ["g", "k"], [F.col("k").asc()], within=["g"])

    assert rows(within(df)) == [(1, "x", 1), (1, "y", 2), (2, "x", 1)]
    assert rows(within(more)) == [(1, "a", 3), (1, "x", 1), (1, "y", 2), (2, "b", 2), (2, "x", 1), (3, "q", 1)]
    late = spark.createDataFrame([(7,)], "k int")
    assert rows(target.numbers("s", late, ["k"], [F.col("k")], start=40)) == [(7, 41)]
    assert rows(target.numbers("s", late.union(spark.createDataFrame([(5,)], "k int")), ["k"], [F.col("k")], start=10)) == [(5, 42), (7, 41)]


def test_a_key_of_several_rows_has_one_number(spark, rows):
    df = spark.createDataFrame([("a", 9), ("a", 1), ("b", 2)], "k string, o int")
    none = df.select("k", F.lit(0).cast("bigint").alias("n")).limit(0)
    assert rows(numbering.kept(none, df, ["k"], [F.col("o").asc()])) == [("a", 1), ("b", 2)]


def test_a_broken_load_leaves_the_old_tables(spark, rows, target):
    """What a load has written before it fails is not seen, and is removed; what it rejected is."""
    one, two = (spark.createDataFrame([(i,)], "v int") for i in (1, 2))
    with target.load():
        target.refresh("t", one)
        target.refresh_slice("s", "a", one)
        target.append_absent("p", lambda known: one, one)
    lost = []
    with pytest.raises(ZeroDivisionError):
        with target.load():
            target.refresh("t", two)
            target.refresh_slice("s", "a", two)
            target.refresh_slice("s", "b", two)
            target.append_absent("p", lambda known: two, two)
            target.refresh("new", two)
            target.reject("why", two)
            lost.append(target.path("new"))
            assert rows(target.read("t")) == [(2,)] and target.read("p").count() == 2
            assert rows(modules.Target(spark, target.folder).read("t")) == [(1,)]  # others still see the old one
            raise ZeroDivisionError
    for seen in (target, modules.Target(spark, target.folder)):
        assert rows(seen.read("t")) == rows(seen.read("p")) == [(1,)] and rows(seen.read("s"), "origin", "v") == [("a", 1)]
        assert not seen.exists("new") and rows(seen.read("rejected/why")) == [(2,)]
    assert not exists(spark, lost[0])
    with target.load():
        target.refresh("t", two)
    assert rows(modules.Target(spark, target.folder).read("t")) == [(2,)]


def test_replaced_folders_go_one_publication_later(spark, rows, target):
    df = spark.createDataFrame([(1,)], "v int")
    places = []
    for _ in range(4):
        target.refresh("t", df)
        places.append(target.path("t"))
    assert [exists(spark, p) for p in places] == [False, False, True, True]


def test_of_two_loads_the_second_to_publish_fails(spark, rows, target):
    df = spark.createDataFrame([(1,)], "v int")
    target.refresh("t", df)
    other = modules.Target(spark, target.folder)
    with pytest.raises(modules.LoadConflictError):
        with target.load():
            target.refresh("t", df.limit(0))
            other.refresh("t", df)
    assert modules.Target(spark, target.folder).read("t").count() == 1
