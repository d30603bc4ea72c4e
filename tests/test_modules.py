"""Whole loads on the smallest tables, and loading again."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.binding import PARAMS, Entities
from checks.registry import Tables
from ledgerlift.plans import fleet, modules, orders, stock
from ledgerlift.session import scratch_path
from ledgerlift.sources.reader import conform
from ledgerlift.sources.schema import ENTITIES, contract

ASSET_ENTITIES = ("asset", "asset_kind", "asset_condition", "asset_placement", "asset_valuation", "depreciation", "org_unit")


def sources(spark, folder):
    e = Entities(Tables(spark, folder))
    found = {n: getattr(e, n) for n in set(ENTITIES) - {"vehicle_make"}}
    found["vehicle_make"] = e.store
    # the fuel documents are of 2024; move them into the fiscal year of the run
    found["fuel_request"] = found["fuel_request"].withColumn("issued", F.col("issued") - F.expr("INTERVAL 26 YEARS"))
    return found


PURCHASING_PLANS = (
    "units", "groups", "subgroups", "items", "destinations", "cost centres", "quotes", "quote lines", "quote bidders",
    "quote prices", "quote awards", "tender headers", "modality register", "tender sessions", "tender bidders", "session bidders",
    "tender offers", "tender items", "tender item details", "tender item funding", "tender lots", "tender item status", "bids",
    "winning rounds", "final bids", "awards signed", "awards", "register docs", "register prices", "register history", "orders",
    "order lines", "order commitments", "commitments", "prior balance", "register balance", "drivers", "vehicle types",
    "vehicle makes", "vehicles", "vehicle cost centres", "fuel documents", "fuel lines", "opening stock", "stock documents",
    "stock lines",
)
ASSET_PLANS = (
    "movement kinds", "adjustment kinds", "asset groups", "write-off reasons", "conditions", "asset kinds", "departments",
    "sectors", "asset register", "asset ledger", "asset write-offs",
)


@pytest.fixture(scope="module")
def purchasing(spark, folder):
    target = modules.Target(spark, scratch_path(spark, "purchasing"))
    modules.load_purchasing(sources(spark, folder), target, replace(PARAMS, block_size=10), on_amendment_miss="skip")
    return target


def test_every_source_row_is_loaded_or_rejected(spark, folder, purchasing):
    found = sources(spark, folder)
    for name in ("org_unit", "tender", "quote_line"):
        good = conform(found[name], contract(name))[0].count()
        assert good + purchasing.read(f"rejected/{name}").count() == found[name].count()
    report = {r.entity: r for r in purchasing.read("reconciled/purchasing").collect()}
    assert [r for r in report.values() if not r.balanced] == [] and set(found) <= set(report)
    assert set(PURCHASING_PLANS) <= set(report)
    assert report["tender headers"].extracted == found["tender"].count() and report["tender headers"].rejected > 0
    assert report["prior balance"].loaded == purchasing.read("prior_balance").count()
    assert purchasing.read("rejected/amendments").columns == ["tender", "material", "added", "new_price"]


def test_a_row_made_twice_or_lost_is_out_of_balance(spark, rows):
    target = modules.Target(spark, scratch_path(spark, "balance"))
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    for name, made in (("good", [1, 2]), ("twice", [1, 2, 2])):
        done = target.refresh(name, spark.createDataFrame([(k,) for k in made], "k int"))
        target.settle(name, wanted, done, {"k": "k"}, name)
    target.refresh("lost", wanted.limit(2))
    target.note("lost", wanted, "lost")
    target.note("summed", wanted.withColumn("_n", F.lit(2)), 6)
    assert rows(target.reconcile("m"), "entity", "extracted", "loaded", "rejected", "balanced") == [
        ("good", 3, 2, 1, True), ("lost", 3, 2, 0, False), ("summed", 6, 6, 0, True), ("twice", 3, 3, 1, False),
    ]
    assert rows(target.read("rejected/good"), "k") == [(3,)]


def test_cleaned_and_cut_texts_are_counted(spark, rows):
    target = modules.Target(spark, scratch_path(spark, "texts"))
    named = [(1, "x" * 50), (2, "a\u4e2d"), (3, None), (None, "\u4e2d" * 99)]
    modules.checked({"person": spark.createDataFrame(named, "number bigint, name string")}, target)
    target.reconcile("m")
    assert rows(target.read("reconciled/m_texts"), "entity", "column", "width", "cleaned", "cut") == [
        ("person", "name", 40, 1, 1), ("person", "name", 70, 1, 0),
    ]


def test_unknown_direct_flags_are_rejected(spark, rows):
    day = "cast('2024-03-01' AS date)"
    movement = spark.sql(f"SELECT 1L number, 2024L year, {day} issued, 5L store, 7L supplier UNION ALL SELECT 2L, 2023L, {day}, 5L, 7L")
    line = spark.sql("""SELECT * FROM VALUES (1L, 1L, 9L, 1D, 1D, 1D, 'S'), (1L, 2L, 9L, 1D, 1D, 1D, 'N'), (1L, 3L, 9L, 1D, 1D, 1D, NULL),
        (2L, 1L, 9L, 1D, 1D, 1D, 'S'), (2L, 2L, 9L, 1D, 1D, 1D, 'N') AS t(movement, line, material, quantity, unit_price, total, direct)""")
    request = spark.sql(f"SELECT 1L number, 2024L year, {day} issued, 5L store, 3L unit, 'N' direct")
    request_line = spark.sql("SELECT 1L request, 1L line, 9L material, 2D quantity")
    items = spark.sql("SELECT 9L material, '001.001.001' code")
    params = replace(PARAMS, fiscal_year=2024)
    made = stock.stock_movements(movement, line, request, request_line, items, params)
    assert rows(stock.unflagged(movement, line, params), "movement", "line") == [(1, 3)]
    expected = stock.expected(movement, line, request, request_line, params).agg(F.sum("_n")).first()[0]
    assert expected == made["lines"].count() + 1 == 5
    kinds = [(r.document, r.inbound, r.outbound) for r in made["headers"].orderBy("document").collect()]
    assert kinds == [(1, "S", "N"), (2, "N", "S"), (3, "S", "S"), (4, "S", "S")]  # 1 E, 1 S, 1 X, 2 X


def test_item_codes_are_unique(purchasing):
    items = purchasing.read("items")
    assert items.select("code").distinct().count() == items.count()
    assert items.filter("serial = '000' AND subgroup = '001'").count() == 0


def test_lines_have_headers(purchasing):
    for lines, headers, key in (
        ("quote_lines", "quotes", "quote"), ("order_lines", "orders", "order_id"), ("stock_lines", "stock_documents", "document"),
        ("tender_items", "tenders", "tender"),
    ):
        orphans = purchasing.read(lines).join(purchasing.read(headers).select(key).distinct(), key, "left_anti")
        if lines != "tender_items":  # tenders of an unknown modality have no header
            assert orphans.count() == 0, lines


def test_stock_origins_live_side_by_side(purchasing, rows):
    counts = purchasing.read("stock_documents").groupBy("origin").count()
    assert [r[0] for r in rows(counts)] == ["fuel", "movement", "opening"]
    lines = purchasing.read("stock_lines")
    assert lines.filter("origin = 'fuel' AND plate IS NOT NULL").count() == lines.filter("origin = 'fuel'").count() > 0
    opening = purchasing.read("stock_documents").filter(stock.is_opening(F.col("doc")))
    assert rows(opening, "origin") == [("opening",)]


def test_an_emptied_slice_goes(spark, rows):
    target = modules.Target(spark, scratch_path(spark, "slices"))
    df = spark.createDataFrame([(1,), (2,)], "v int")
    target.refresh_slice("t", "a", df)
    target.refresh_slice("t", "b", df)
    assert rows(target.refresh_slice("t", "a", df.limit(0)), "origin", "v") == [("b", 1), ("b", 2)]


def test_loading_tenders_again_changes_nothing(spark, folder, purchasing):
    names = ["tenders", "tender_sessions", "tender_lots", "tender_item_status", "winning_rounds", "final_bids", "awards", "register_docs"]
    before = {r.table: r.loaded for r in modules.table_counts(purchasing, names).collect()}
    s = modules.checked(sources(spark, folder), purchasing)
    modules.load_tenders(s, purchasing, PARAMS, on_amendment_miss="skip")
    modules.load_stock(s, purchasing, PARAMS)
    assert {r.table: r.loaded for r in modules.table_counts(purchasing, names).collect()} == before
    assert min(before.values()) > 0


def test_changed_sources_replace_bids_and_extend_the_register(spark, folder):
    """Prices double and half the tenders leave the price register; what was registered stays."""
    target = modules.Target(spark, scratch_path(spark, "twice"))
    s = modules.checked(sources(spark, folder), target)
    modules.load_catalog(s, target, PARAMS)
    modules.load_tenders(s, target, PARAMS, on_amendment_miss="skip")
    first = {n: target.read(n).count() for n in ("register_docs", "register_prices", "register_history")}
    s["bid_round"] = s["bid_round"].withColumn("price", F.col("price") * 2)
    s["tender_offer"] = s["tender_offer"].withColumns({c: F.col(c) * 2 for c in ("unit_price", "total")})
    half = F.when(F.col("number") % 2 == 0, "N").otherwise(F.col("price_register"))
    s["tender"] = s["tender"].withColumn("price_register", half)
    modules.load_tenders(s, target, PARAMS, on_amendment_miss="skip")

    def total(name, where="true"):
        return target.read(name).filter(where).agg(F.sum(F.col("total").cast("decimal(38,6)"))).first()[0]

    assert total("final_bids") == total("bids")
    assert total("winning_rounds") == total("bids", "won = 1")
    assert {n: target.read(n).count() for n in first} == first
    for name in ("register_prices", "register_history"):
        assert target.read(name).groupBy("tender", "bidder", "code", "centre", "line").count().filter("count > 1").isEmpty()


def test_awards_have_one_row_per_bidder_and_line(purchasing):
    award = purchasing.read("awards")
    assert award.count() == award.select("tender", "line", "bidder").distinct().count()


def test_a_key_held_twice_stops_the_load(spark, folder):
    target = modules.Target(spark, scratch_path(spark, "double"))
    e = sources(spark, folder)
    with pytest.raises(modules.DuplicateKeyError, match="person"):
        modules.checked({"person": e["person"].union(e["person"].limit(1))}, target)
    assert target.read("rejected/duplicates/person").count() == 1


def test_each_source_is_read_once_and_scratch_is_empty_afterwards(spark, folder, tmp_path):
    target = modules.Target(spark, str(tmp_path / "target"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    found = {n: df for n, df in sources(spark, folder).items() if n in ASSET_ENTITIES}
    rows_of = found["asset_placement"].count()
    found["asset_placement"] = found["asset_placement"].mapInArrow(counted, found["asset_placement"].schema)
    before = _scratch(spark)
    modules.load_assets(found, target, PARAMS)
    assert read.value == rows_of
    assert _scratch(spark) == before


def _scratch(spark):
    place = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    return {p.name for p in place.iterdir()} if place.exists() else set()


def test_assets_module(spark, folder, rows):
    target = modules.Target(spark, scratch_path(spark, "assets"))
    found = sources(spark, folder)
    for _ in range(2):
        modules.load_assets({n: found[n] for n in ASSET_ENTITIES}, target, PARAMS)
    ledger, register = target.read("asset_ledger"), target.read("assets")
    assert ledger.select("movement").distinct().count() == ledger.count()
    moves = ledger.filter("kind <> 'B' AND depreciation = 'N' AND history <> 'REAVALIACAO'")
    assert moves.count() <= found["asset_placement"].count()  # a placement moves once
    report = {r.entity: r for r in target.read("reconciled/assets").collect()}
    assert [r for r in report.values() if not r.balanced] == [] and set(ASSET_PLANS) <= set(report)
    closed = register.filter("closed IS NOT NULL").count()
    assert ledger.filter("kind = 'B'").count() == closed > 0
    assert rows(target.read("movement_kinds"), "kind") == [("A",), ("B",), ("P",), ("R",), ("T",)]
    assert target.read("adjustment_kinds").count() == target.read("asset_groups").count() == 1


def test_numbers_stay_when_rows_are_added(spark, folder):
    """A second load, with rows that sort before all others, changes no code, order number or cost centre of the first."""
    target = modules.Target(spark, scratch_path(spark, "kept"))
    full = sources(spark, folder)
    fewer = dict(full)
    fewer["catalog_item"] = full["catalog_item"].filter("number % 7 <> 1")
    fewer["purchase_order"] = full["purchase_order"].filter("number % 5 <> 1")
    fewer["vehicle"] = full["vehicle"].filter("crc32(cast(concat_ws('', plate_letters, plate_digits) AS binary)) % 3 <> 1")
    params = replace(PARAMS, block_size=10)
    keyed = {"groups": ["kind", "number", "group_code"], "items": ["family", "material", "code"], "orders": ["order_id", "doc"]}
    before = {}
    for s in (fewer, full):
        good = modules.checked(s, target)
        modules.load_catalog(good, target, params)
        register = good["tender"].select(F.col("number").alias("tender")).limit(0)
        target.refresh("orders", orders.order_headers(good["purchase_order"], good["order_line"], register, params, target.numbers))
        vehicles = fleet.vehicles(good["vehicle"], good["fuel_type"])
        units = target.read("cost_centres").filter("origin = 'unit'")
        target.refresh("vehicle_centres", fleet.vehicle_cost_centres(vehicles, units, params, target.numbers))
        now = {n: {tuple(r) for r in target.read(n).select(*c).collect()} for n, c in (*keyed.items(), ("vehicle_centres", ["plate", "centre"]))}
        for name, old in before.items():
            assert old <= now[name], name
        grown = {n for n in before if len(now[n]) > len(before[n])}
        before = now
    assert {"items", "orders", "vehicle_centres"} <= grown
    for name, found in before.items():
        assert len({r[-1] for r in found}) == len(found), name
