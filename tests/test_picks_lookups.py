import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import lookups as L
from ledgerlift.operators import picks as P


def test_price_tie_and_null_price(spark, rows):
    df = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0), (1, "c", None), (2, "d", None)], "k int, who string, p double")
    best = P.first_per_key(df, ["k"], [F.col("p").asc_nulls_last(), F.col("who").asc()])
    assert rows(best, "k", "who") == [(1, "a"), (2, "d")]


def test_unknown_year_counts_as_latest(spark, rows):
    df = spark.createDataFrame([("P1", 2010, 1), ("P1", None, 2), ("P2", 2001, 3)], "plate string, y int, id int")
    kept = P.first_per_key(df, ["plate"], [F.col("y").desc_nulls_first(), F.col("id").asc()])
    assert rows(kept, "plate", "id") == [("P1", 2), ("P2", 3)]


def test_best_with_ties_keeps_ties_and_drops_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", 3, 1), ("a", 3, 2), ("a", 1, 3), ("b", None, 4), (None, 9, 5)], "k string, r int, id int"
    )
    assert rows(P.best_with_ties(df, ["k"], "r"), "id") == [(1,), (2,)]


def test_group_count_counts_null_keys_as_one_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k int, id int")
    assert rows(P.with_group_count(df, ["k"], "n"), "id", "n") == [(1, 2), (2, 2), (3, 1)]


def test_semi_and_anti_join_with_null_keys(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "o int")
    assert rows(P.matching(df, other, {"k": "o"})) == [(1,)]
    assert rows(P.unmatched(df, other, {"k": "o"})) == [(2,), (None,)]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, k int")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(10, "ten", 1.5)], "key int, label string, amount double")


def test_miss_policies(facts, dim, rows):
    on = {"k": "key"}
    assert rows(L.lookup(facts, dim, on, ["label"], "null"), "id", "label") == [(1, "ten"), (2, None), (3, None)]
    assert rows(L.lookup(facts, dim, on, ["label"], "blank"), "id", "label") == [(1, "ten"), (2, ""), (3, "")]
    assert rows(L.lookup(facts, dim, on, ["label"], "skip"), "id", "label") == [(1, "ten")]
    assert rows(L.lookup(facts, dim, on, ["amount"], "zero"), "id", "amount") == [(1, 1.5), (2, 0.0), (3, 0.0)]
    assert rows(L.misses(facts, dim, on), "id") == [(2,), (3,)]


def test_failing_miss_names_the_key(facts, dim):
    with pytest.raises(Exception, match="no label for k = "):
        L.lookup(facts, dim, {"k": "key"}, ["label"], "fail").collect()
    assert L.lookup(facts.filter("id = 1"), dim, {"k": "key"}, ["label"], "fail").count() == 1


def test_failing_lookup_keeps_a_null_value_of_a_known_key(spark, rows):
    facts = spark.createDataFrame([(1,)], "k int")
    dim = spark.createDataFrame([(1, None)], "key int, label string")
    assert rows(L.lookup(facts, dim, {"k": "key"}, ["label"], "fail")) == [(1, None)]


def test_unknown_policy_is_refused(facts, dim):
    with pytest.raises(ValueError):
        L.lookup(facts, dim, {"k": "key"}, ["label"], "guess")


def test_duplicate_dimension_keys(spark, rows):
    dim = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "code string, id int")
    assert rows(L.unique_keys(dim, ["code"], ["id"])) == [("x", 1), ("y", 3)]
    assert rows(L.duplicate_keys(dim, ["code"])) == [("x", 2)]
