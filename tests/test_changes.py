import pytest
from pyspark.sql import functions as F

from ledgerlift.operators import audit, changes, picks
from ledgerlift.operators.lookups import lookup


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "d", 40)], "k int, name string, v int")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(1, 111), (2, None), (9, 999)], "key int, new int")


KEY = {"k": "key"}


def test_merge_overwrites_matched_rows_also_with_null(target, source, rows):
    assert rows(changes.merge_matched(target, source, KEY, {"v": "new"}), "name", "v") == [
        ("a", 111), ("b", None), ("c", 30), ("d", 40)
    ]


def test_update_from_subquery_blanks_unmatched_rows(target, source, rows):
    assert rows(changes.set_from(target, source, KEY, "v", "new"), "name", "v") == [
        ("a", 111), ("b", None), ("c", None), ("d", None)
    ]


def test_update_where_leaves_other_rows(target, source, rows):
    found = changes.set_from_where(target, source, KEY, "v", "new", F.col("name") != "c")
    assert rows(found, "name", "v") == [("a", 111), ("b", None), ("c", 30), ("d", None)]


def test_update_if_exists(target, source, rows):
    twice = source.unionByName(source)
    found = changes.set_if_exists(target, twice, KEY, {"name": F.lit("hit")})
    assert rows(found, "name", "v") == [("c", 30), ("d", 40), ("hit", 10), ("hit", 20)]


def test_update_sees_old_values(target, rows):
    found = changes.set_where(target, F.col("v") < 25, {"v": F.lit(0), "name": F.col("v").cast("string")})
    assert rows(found, "name", "v") == [("10", 0), ("20", 0), ("c", 30), ("d", 40)]


def test_append_absent_twice_adds_nothing_but_null_keys(spark, rows):
    old = spark.createDataFrame([(1,)], "k int")
    new = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    once = changes.append_absent(old, new, ["k"])
    assert rows(once) == [(1,), (2,), (3,)]
    assert rows(changes.append_absent(once, new, ["k"])) == [(1,), (2,), (3,)]
    unknown = spark.createDataFrame([(None,)], "k int")
    assert changes.append_absent(changes.append_absent(old, unknown, ["k"]), unknown, ["k"]).count() == 3


def test_slice_refresh_keeps_false_and_null(spark, rows):
    df = spark.createDataFrame([("fuel", 1), ("other", 2), (None, 3)], "origin string, id int")
    new = spark.createDataFrame([("fuel", 9)], "origin string, id int")
    where = F.col("origin") == "fuel"
    once = changes.replace_slice(df, new, where)
    assert rows(once, "id") == [(2,), (3,), (9,)]
    assert rows(changes.replace_slice(once, new, where), "id") == [(2,), (3,), (9,)]


def test_orphan_headers_go(spark, rows):
    header = spark.createDataFrame([(1,), (2,)], "id int")
    detail = spark.createDataFrame([(1,), (1,)], "head int")
    assert rows(changes.drop_orphans(header, detail, {"id": "head"})) == [(1,)]


def test_sentinel_and_text_column(target, rows):
    assert changes.with_sentinel(target, (0, "none", 0)).count() == 5
    assert changes.add_text_column(target, "extra").schema["extra"].dataType.simpleString() == "string"


def test_reconcile(spark):
    frame = spark.range(10)
    row = audit.reconcile("x", frame, frame.filter("id < 7"), frame.filter("id >= 7")).first()
    assert (row.extracted, row.loaded, row.rejected, row.balanced) == (10, 7, 3, True)
    assert not audit.reconcile("x", frame, frame, frame).first().balanced


def test_cleanup_audit(spark, rows):
    df = spark.createDataFrame([("a", "x😀y日"), ("a", "plain"), ("b", None)], "g string, t string")
    assert rows(audit.cleanup_audit(df, ["t"], "g"), "g", "changed_rows", "removed_chars") == [("a", 1, 2), ("b", 0, 0)]


@pytest.mark.parametrize("joined", [
    lambda t, s: changes.merge_matched(t, s, {"k": "k"}, {"v": "w"}),
    lambda t, s: changes.set_from(t, s, {"k": "k"}, "v", "w"),
    lambda t, s: changes.set_from_where(t, s, {"k": "k"}, "v", "w", F.lit(True)),
    lambda t, s: lookup(t, s, {"k": "k"}, ["w"], "null"),
    lambda t, s: lookup(t, s, {"k": "k"}, ["w"], "skip"),
], ids=["merge_matched", "set_from", "set_from_where", "lookup", "lookup_skip"])
def test_a_doubled_key_stops_the_job(spark, rows, joined):
    """NULL keys match nothing and may repeat; any other key may not, also one that no target row has."""
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    side = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k int, w string")
    assert len(rows(joined(target, side))) in (1, 3)
    for more in ((1, "x"), (1, None)):
        with pytest.raises(Exception, match="more than one row for k = 1"):
            joined(target, side.union(spark.createDataFrame([more], side.schema))).collect()
    twice = side.union(spark.createDataFrame([(9, "x"), (9, "y")], side.schema))
    with pytest.raises(Exception, match="k = 9"):
        joined(target, twice).collect()


def test_unique_by_construction_is_not_checked(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    side = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    assert rows(changes.set_from(target, side, {"k": "k"}, "v", "w", unique=True)) == [(1, "x"), (1, "y")]


def test_first_by_orders_nulls_last(spark, rows):
    df = spark.createDataFrame([("a", None, 1, "x"), ("a", 5, 9, "y"), ("a", 5, 3, None), (None, 1, 1, "n"), (None, 0, 2, "m"), ("b", None, None, None)],
                               "k string, o int, p int, v string")
    assert rows(picks.first_by(df, ["k"], ["o"], ["p", "v"])) == [("a", 3, None), ("b", None, None), (None, 2, "m")]
    assert rows(picks.first_by(df, ["k"], ["o", "p"], ["v"])) == [("a", None), ("b", None), (None, "m")]
