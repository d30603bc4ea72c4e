from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.plans import tenders


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("number, width, cut, grown, signed", [
    (7, 5, "00007", "00007", " 00007"), (123456, 5, "12345", "123456", " 123456"), (0, 3, "000", "000", " 000"),
    (7.0, 3, "007", "007", " 007"),
])
def test_padding(spark, number, width, cut, grown, signed):
    n = F.lit(number)
    assert (one(spark, X.pad_cut(n, width)), one(spark, X.pad_grow(n, width)), one(spark, X.pad_signed(n, width))) == (cut, grown, signed)


def test_document_numbers(spark):
    doc = X.doc_number(F.lit(42), F.lit(2005), 6)
    assert one(spark, doc) == "000042/05"
    assert one(spark, X.doc_serial(doc)) == "000042"
    assert one(spark, X.doc_number(F.lit(1234567), F.lit(2024), 6, X.pad_cut)) == "123456/24"
    assert one(spark, X.item_code(F.lit("001"), F.lit("002"), F.lit("003"))) == "001.002.003"


def test_concatenation_of_null_and_empty(spark):
    parts = [F.lit("a"), F.lit(None).cast("string"), F.lit("")]
    assert one(spark, X.join_loose(*parts)) == "a"
    assert one(spark, X.join_strict(*parts)) is None


def test_numbers_from_text(spark):
    assert [one(spark, X.parse_number(F.lit(t))) for t in (" 12 ", "x1", "")] == [12, None, None]


@pytest.mark.parametrize("text, kept", [
    ("Ação – “x” €", "Ação – “x” €"), ("a😀b日c", "abc"), ("\u0080\u0081", "\u0081"), ("", ""), (None, None),
    ("tab\tnew\n", "tab\tnew\n"), ("naïve Ž ž Ÿ †", "naïve Ž ž Ÿ †"), ("ą ę ř", "  "),
])
def test_code_page(spark, text, kept):
    assert one(spark, X.keep_code_page(F.lit(text).cast("string"))) == kept


def test_kept_characters_are_those_of_the_code_page(spark):
    text = "".join(chr(c) for c in range(0x3000) if not 0xD800 <= c <= 0xDFFF)
    df = spark.createDataFrame([(c,) for c in text], "c string")
    kept = {r.c for r in df.filter(X.keep_code_page(F.col("c")) != "").collect()}
    passed = {0x81, 0x8D, 0x8F, 0x90, 0x9D}
    page = {bytes([b]).decode("cp1252") for b in range(256) if b not in passed}
    assert kept == page | {chr(b) for b in passed}


def test_leap_day(spark):
    assert one(spark, V.one_year_later(F.lit(date(2020, 2, 29)))) == date(2021, 2, 28)


@pytest.mark.parametrize("a, b, ratio", [(10.0, 0.0, 0.0), (10.0, None, 0.0), (1.0, 3.0, 0.33), (0.01, 0.08, 0.13), (-1.0, 8.0, -0.13)])
def test_safe_ratio(spark, a, b, ratio):
    assert one(spark, V.safe_ratio(F.lit(a), F.lit(b).cast("double"))) == ratio


def test_flags(spark):
    assert [one(spark, V.hidden_flag(F.lit(x).cast("string"))) for x in ("S", "N", None)] == ["N", "S", "S"]
    assert [one(spark, V.control_kind(F.lit(x).cast("double"))) for x in (1.0, 2.0, None)] == ["V", "Q", "Q"]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e9, -1e9]
    sums = {
        spark.createDataFrame([(v,) for v in order], "v double").agg(V.exact_sum(F.col("v")).alias("s")).first().s
        for order in (values, values[::-1])
    }
    assert sums == {1.0}


def test_sums_keep_four_places(spark):
    rows = spark.range(1000).select(F.lit(0.004).alias("v"), F.lit(0.0001).alias("w"))
    assert rows.agg(V.exact_sum(F.col("v")).alias("v"), V.exact_sum(F.col("w")).alias("w")).first()[:] == (4.0, 0.1)


def test_long_numbers_stay_apart(spark):
    rows = spark.range(999_990, 1_000_030).select(
        X.doc_number(F.col("id"), F.lit(1998), 6).alias("doc"), X.pad_grow(F.col("id"), 5).alias("serial"),
        X.after_first(F.col("id")).alias("subgroup"))
    for c in ("doc", "serial", "subgroup"):
        assert rows.select(c).distinct().count() == 40, c
    assert one(spark, X.after_first(F.lit(1001))) == "001" and one(spark, X.after_first(F.lit(10011))) == "0011"


@pytest.mark.parametrize("text", ["8:30", "8:30:15", "08:30", "0830", "08:30:15"])
def test_clock_keeps_the_minutes(spark, text):
    assert one(spark, tenders.clock(F.lit(text))) == "0830"


def test_no_number_is_cut_in_plans():
    for path in (Path(__file__).resolve().parent.parent / "ledgerlift" / "plans").glob("*.py"):
        assert "pad_cut" not in path.read_text(), path.name


def test_cuts_by_bytes_split_no_letter(spark):
    texts = ["", "abc", "aé", "aéb", "€€", "a€", "𝄞a", "a𝄞", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for width in range(6):
        found = [r[0] for r in df.select(X.cut_bytes(F.col("t"), width)).collect()]
        assert found == [None if t is None else t.encode()[:width].decode(errors="ignore") for t in texts], width
