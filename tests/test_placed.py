"""The tender chain placed by tender: what still goes through a shuffle, and that rows are the same."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import load
from checks.binding import Entities
from checks.registry import Tables
from checks.tender_queries import Chain
from ledgerlift.operators.picks import best_with_ties
from ledgerlift.params import RunParams
from ledgerlift.plans import tenders
from ledgerlift.session import placed_joins, written_by

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sources(spark):
    kinds = {
        "offer": "tender long, material long, bidder long, line long, quantity double, unit_price double, total double, lowest int, offer date",
        "catalog": "number long", "item": "tender long, material long, annex string, failed string", "tender": "number long, year long",
        "average": "tender long, material long, avg_price double, total double", "codes": "material long, code string",
        "rounds": "tender long, bidder long, material long, round long, price double, winner string",
    }
    data = {
        "offer": [(t, m, b, m, 2.0, 3.0 + b, 6.0, 1, None) for t in (1, 2, 3, None) for m in (5, 6, 7, 8, None) for b in (1, 2)] * 2,
        "catalog": [(5,), (6,), (6,), (8,), (None,)], "tender": [(1, 1998), (1, 1998), (2, 1990), (None, 1998)],
        "item": [(t, m, "N", None if m == 5 else "S") for t in (1, 2, 3, None) for m in (5, 7, 8, None)] + [(1, 6, "S", None), (1, 5, "N", "S")],
        "average": [(t, m, 1.5, 3.0) for t in (1, 2, 3) for m in (5, 6, 7, 8)], "codes": [(5, "a"), (6, "b"), (8, "c"), (None, "d")],
        "rounds": [(1, b, 5, r, float(r), w) for b in (1, 2) for r in (1, 2, 2) for w in ("S", "N")] + [(None, 1, 5, 9, 1.0, "S")],
    }
    return {name: spark.createDataFrame(data[name], kind) for name, kind in kinds.items()}


def opened(s, codes=None):
    return tenders.open_offers(s["offer"], s["catalog"], s["item"], s["tender"], codes)


def test_offers_with_codes_give_the_same_items_and_bids(sources, no_broadcast, rows):
    s, params = sources, RunParams(company=1, fiscal_year=1998)
    plain, coded = opened(s), written_by(opened(s, s["codes"]), "offers", "tender")
    assert rows(coded, *plain.columns) == rows(plain) and plain.count() > 0
    before = tenders.tender_items(tenders.best_offers(plain, s["average"]), s["codes"])
    after = written_by(tenders.tender_items(tenders.best_offers(coded, s["average"])), "items", "tender")
    assert rows(after) == rows(before) and after.columns == before.columns
    for found, wanted in (
        (tenders.bids_rounds(s["rounds"], after), tenders.bids_rounds(s["rounds"], before)),
        (tenders.bids_direct(coded, s["tender"], s["rounds"], None, params), tenders.bids_direct(plain, s["tender"], s["rounds"], s["codes"], params)),
    ):
        assert rows(found) == rows(wanted) and wanted.count() > 0


def test_a_missing_code_or_average_stops_the_run(sources):
    s = sources
    few = s["codes"].filter("material <> 8")
    best = tenders.best_offers(opened(s, few), s["average"])
    with pytest.raises(PySparkException, match="no code for avg_material = 8"):
        tenders.tender_items(best).collect()
    assert best.count() == tenders.best_offers(opened(s), s["average"]).count()  # as long as no code is asked for
    best = tenders.best_offers(opened(s, s["codes"]), s["average"].filter("material <> 8"))
    with pytest.raises(PySparkException, match="no code for avg_material = NULL"):
        tenders.tender_items(best).collect()
    with pytest.raises(PySparkException, match="no code for material = 8"):
        tenders.bids_direct(opened(s, few), s["tender"], s["rounds"], None, RunParams(company=1, fiscal_year=1998)).collect()


def test_rows_placed_by_tender_are_not_shuffled_again(spark, sources, no_broadcast):
    s = sources
    offers = written_by(opened(s, s["codes"]), "offers", "tender")
    assert "Exchange" not in plan(offers.groupBy("tender", "line").agg(F.min("unit_price")))
    with placed_joins(spark):
        items = tenders.tender_items(tenders.best_offers(offers, tenders.by_tender(s["average"])))
        assert plan(items).count("Exchange hashpartitioning(") == 1  # the averages
        items = written_by(items, "items", "tender")
        rounds = tenders.bids_rounds(s["rounds"], items)
        text = plan(rounds)
        assert text.count("Exchange hashpartitioning(tender#") == text.count("Exchange hashpartitioning(") == 2  # the rounds, and their last


def test_the_setting_is_put_back(spark, sources):
    before = spark.conf.get(CO_PARTITION, None)
    written_by(sources["codes"], "codes", "material")
    with pytest.raises(ZeroDivisionError), placed_joins(spark):
        assert spark.conf.get(CO_PARTITION) == "false"
        raise ZeroDivisionError
    assert spark.conf.get(CO_PARTITION, None) == before


def test_rounds_go_through_one_shuffle_where_the_last_is_found_in_place(spark, sources, no_broadcast, rows):
    s = sources
    more = [(1, 1, None, 3, 1.0, "S"), (1, None, 5, 3, 1.0, "S"), (1, 1, 5, None, 1.0, "S"), (2, 1, 7, 1, 4.0, None), (2, 1, 7, 1, 4.0, None)]
    bid_round = s["rounds"].unionByName(spark.createDataFrame(more, s["rounds"].schema))
    items = written_by(tenders.tender_items(tenders.best_offers(written_by(opened(s, s["codes"]), "offers", "tender"), s["average"])), "items", "tender")
    twice = tenders.bids_rounds(bid_round, items)
    assert rows(tenders.bids_rounds(bid_round, items, once=True)) == rows(twice) and twice.count() > 0
    with placed_joins(spark):
        once = tenders.bids_rounds(bid_round, items, once=True)
        assert plan(once).count("Exchange hashpartitioning(") == 1


def test_the_last_rounds_of_placed_rows_are_the_same(spark, rows):
    data = [(1, 1, 3), (1, 1, 3), (1, 1, 2), (1, 2, None), (1, 2, 1), (None, 1, 9), (2, None, 9), (3, 1, None)]
    df = spark.createDataFrame(data, "tender long, bidder long, round long")
    found = best_with_ties(tenders.by_tender(df), ["tender", "bidder"], "round", placed=True)
    assert rows(found) == rows(best_with_ties(df, ["tender", "bidder"], "round")) == [(1, 1, 3), (1, 1, 3), (1, 2, 1)]


@pytest.mark.parametrize("name", ["p_winning_rounds", "p_final_bids", "p_price_register", "p_price_register_history"])
def test_results_of_the_chain_are_planned_in_their_place(spark, folder, no_broadcast, name):
    found = load()[0][name](spark, folder)
    assert "Exchange" not in plan(found) and found.count() > 0


def test_landed_rows_are_packed_with_zstd(sources, rows):
    landed = written_by(sources["codes"], "codes", "material")
    assert all(".zstd." in name for name in landed.inputFiles()) and rows(landed) == rows(sources["codes"])


def test_rounds_are_made_once_for_the_awards(spark, folder):
    chain = Chain(Tables(spark, folder))
    assert "Join" not in plan(chain.rounds) and chain.awards.count() > 0


def test_flags_of_tender_items(spark, tmp_path, rows):
    lines = [(1, 5, 2, 0.04, "A"), (1, 5, 1, 0.10, None), (1, 6, 3, None, "R"), (1, 6, 4, 0.09, "N"), (None, 6, 1, None, None), (2, None, 1, 0.1, "R")]
    kind = "l_orderkey long, l_partkey long, l_linenumber int, l_discount double, l_returnflag string"
    spark.createDataFrame(lines, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = Entities(Tables(spark, str(tmp_path))).tender_item
    assert rows(found) == [(1, 5, 1, "S", None), (1, 6, 3, "N", "S"), (2, None, 1, "S", "S"), (None, 6, 1, "N", None)]
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "AS annex" in lines[[i for i, line in enumerate(lines) if "RepartitionByExpression" in line][0] + 1]


def test_tender_items_are_grouped_by_all_tasks(spark, folder):
    found = Entities(Tables(spark, folder)).tender_item
    assert found.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_prices_of_placed_offers_do_not_go_through_the_shuffle(spark, tmp_path, no_broadcast, rows):
    lines = [(1, 5, 7, 1, 4.0, 10.0, "A", None), (1, 5, 7, 1, 4.0, 10.0, "A", None), (2, 6, None, 2, None, 3.0, "N", None), (None, 6, 8, 3, 3.0, None, None, None)]
    kind = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,
        l_returnflag string, l_shipdate timestamp"""
    spark.createDataFrame(lines, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    e = Entities(Tables(spark, str(tmp_path)))
    assert rows(e.placed_offer) == rows(e.tender_offer) and e.placed_offer.schema == e.tender_offer.schema
    assert [r.unit_price for r in e.placed_offer.filter("tender = 1").collect()] == [2.5, 2.5]
    text = plan(tenders.by_tender(e.placed_offer)).splitlines()
    shuffles = [i for i, line in enumerate(text) if "Exchange" in line]
    assert len(shuffles) == 1 and not any("unit_price" in line for line in text[shuffles[0]:])


@pytest.mark.parametrize("name", ["p_winning_rounds", "p_price_register_docs"])
def test_offers_of_the_chain_are_made_of_placed_ones(spark, folder, no_broadcast, monkeypatch, name):
    landed = {}
    monkeypatch.setattr("checks.tender_queries.written_by", lambda df, label, key: landed.setdefault(label, df))
    load()[0][name](spark, folder)
    assert {"offers", "tender-items", "bids", "winning-rounds"} <= set(landed)
    text = landed["offers"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [text[i + 1] for i, line in enumerate(text) if "RepartitionByExpression" in line]
    assert any("AS total" in line for line in below) and not any("AS unit_price" in line for line in below)
