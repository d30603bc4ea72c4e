"""Plans on hand-made rows for cases the given tables do not hold."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift.params import RunParams
from ledgerlift.plans import assets, orders, quotes, stock, tenders
from ledgerlift.sources.schema import contract

P = RunParams(company=3, fiscal_year=2020)


@pytest.fixture
def frame(spark):
    """Rows given as dicts, with the entity's contract as schema."""

    def build(entity, *records):
        schema = contract(entity)
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)

    return build


def test_last_round_tie_and_null_round(spark, frame, rows):
    bids = frame(
        "bid_round",
        dict(tender=1, bidder=7, material=5, round=2, price=3.0, winner="S"),
        dict(tender=1, bidder=7, material=5, round=2, price=4.0, winner="N"),
        dict(tender=1, bidder=7, material=5, round=1, price=9.0, winner="N"),
        dict(tender=1, bidder=8, material=5, round=None, price=1.0, winner="S"),
    )
    items = spark.createDataFrame(
        [(1, 1, 5, 2.0, "c", "S"), (1, 2, 5, 1.0, "c", None)],
        "tender bigint, line bigint, material bigint, quantity double, code string, failed string",
    )
    assert rows(tenders.bids_rounds(bids, items), "line", "total", "status", "won", "control") == [
        (1, 6.0, "D", 1, "Q"), (1, 8.0, "D", 0, "Q"), (2, 3.0, "C", 1, "V"), (2, 4.0, "C", 0, "V")
    ]


def test_unknown_modality_is_rejected(frame, rows):
    tender = frame("tender", dict(number=1, year=2020, process_number=2, modality=7), dict(number=2, year=2020, process_number=1, modality=70))
    loaded = tenders.tenders(tender, frame("modality_names", dict(code=8, name="OWN")), P)
    assert rows(loaded["tenders"], "tender", "sequence", "modality_name", "short_code") == [(1, "000002/20", "OWN", "PP01")]
    assert rows(loaded["rejected"], "number") == [(2,)]


def test_price_register_on_leap_day_and_second_run(spark, rows):
    headers = spark.createDataFrame(
        [(1, "S", date(2020, 2, 29)), (2, "S", None), (3, "N", date(2020, 1, 1))], "tender bigint, price_register string, approved date"
    )
    award = spark.createDataFrame(
        [(1, 7, "c", 0, 1, 2.0, 3.0, 6.0, 1, "C", None), (3, 7, "c", 0, 1, 2.0, 3.0, 6.0, 1, "C", None)],
        "tender bigint, bidder bigint, code string, centre bigint, line bigint, quantity double, unit_price double, total double, "
        "won bigint, status string, brand string",
    )
    none = {k: award.limit(0) for k in ("register_docs", "register_prices", "register_history")}
    first = tenders.price_register(headers, award, none)
    assert rows(first["register_docs"], "tender", "valid_until") == [(1, date(2021, 2, 28))]
    again = tenders.price_register(headers, award, first)
    assert [again[k].count() for k in none] == [0, 0, 0]


def test_amendment_of_unknown_item_stops_or_is_left_out(spark, frame, rows):
    award = spark.createDataFrame(
        [(1, 1, 2.0, 10.0, 20.0, 1, None, None, None), (1, 2, 1.0, 5.0, 5.0, 1, 1.0, 5.0, 5.0)],
        "tender bigint, line bigint, quantity double, unit_price double, total double, won bigint, "
        "amended_quantity double, amended_price double, amended_total double",
    )
    items = spark.createDataFrame([(1, 50, 1), (1, 51, 2)], "tender bigint, material bigint, line bigint")
    request = frame("request", dict(number=9, type=2), dict(number=8, type=1))
    lines = frame("request_line", dict(request=9, material=50, quantity=3.0), dict(request=9, material=99, quantity=1.0), dict(request=8, material=51, quantity=7.0))
    of = frame("request_tender", dict(request=9, tender=1), dict(request=8, tender=1))
    prices = frame("price_adjustment", dict(tender=1, material=50, unit_price=12.0, starts=date(2020, 1, 1)), dict(tender=1, material=50, unit_price=11.0, starts=date(2020, 5, 1)))
    with pytest.raises(Exception, match="no line for tender, material = 1,99"):
        tenders.amendments(award, items, request, lines, of, prices).collect()
    found = tenders.amendments(award, items, request, lines, of, prices, on_miss="skip")
    assert rows(found, "line", "amended_quantity", "amended_price", "amended_total") == [(1, 5.0, 11.0, 55.0), (2, 1.0, 5.0, 5.0)]


def test_two_quotes_of_one_number_keep_their_headers(frame, rows):
    quote = frame("quote", dict(number=1, year=2020, doc_number=5), dict(number=2, year=2020, doc_number=5), dict(number=3, year=2020, doc_number=6))
    lines = frame("quote_line", dict(quote=1, line=1, material=1, quantity=1.0), dict(quote=2, line=1, material=1, quantity=1.0))
    assert rows(quotes.quote_headers(quote, lines, P), "quote", "doc") == [(1, "00005/20"), (2, "00005/20")]


def test_line_without_winner_keeps_null_total(spark, rows):
    lines = spark.createDataFrame([(1, 1, "c", 2.0), (1, 2, "c", 2.0)], "quote bigint, line bigint, code string, quantity double")
    prices = spark.createDataFrame(
        [(1, 1, 7, 4.0), (1, 1, 6, 4.0), (1, 2, None, None)], "quote bigint, line bigint, winner bigint, won_price double"
    )
    assert rows(quotes.quote_awards(lines, prices), "line", "winner", "unit_price", "total") == [(1, 6, 4.0, 8.0), (2, None, 0.0, None)]


def test_line_annulled_twice_counts_once(frame, spark, rows):
    order = frame("purchase_order", dict(number=1, year=2019, doc_number=1, tender=4), dict(number=2, year=2019, doc_number=2, tender=4, parent=1))
    line = frame("order_line", dict(order_id=1, line=1, material=5, quantity=10.0, total=100.0), dict(order_id=2, line=1, material=5, quantity=99.0, total=1.0))
    cut = frame("order_annulment", dict(order_id=1, line=1, quantity=2.0, value=20.0), dict(order_id=1, line=1, quantity=3.0, value=30.0))
    items = spark.createDataFrame([(4, "c5", 8)], "tender bigint, code string, line bigint")
    codes = spark.createDataFrame([(5, "c5")], "material bigint, code string")
    assert rows(orders.prior_balance(order, line, cut, items, codes, P)) == [(2019, 4, 8, "c5", 5.0, 50.0)]


def test_reissued_numbers_parents_and_commitments(frame, spark, rows):
    order = frame(
        "purchase_order",
        dict(number=30, year=2020, doc_number=2, sub_number=0, commitment=1, tender=4),
        dict(number=10, year=2020, doc_number=2, sub_number=0, commitment=1),
        dict(number=20, year=2020, doc_number=1, sub_number=1, commitment=2, parent=30),
        dict(number=40, year=2020, doc_number=9, sub_number=0, commitment=3),
    )
    line = frame("order_line", *(dict(order_id=n, line=1, material=5, quantity=1.0, total=1.0) for n in (10, 20, 30)))
    headers = orders.order_headers(order, line, spark.createDataFrame([(4,)], "tender bigint"), P)
    assert rows(headers, "order_id", "doc", "parent_doc", "register_version") == [
        (10, "00002/20", None, None), (20, "00001/20", "00003/20", None), (30, "00003/20", None, 0)
    ]
    budget = frame("commitment", dict(number=1, amount=50.0), dict(number=2, amount=9.0), dict(number=3, amount=0.0))
    used = orders.order_commitments(headers, budget)
    assert rows(used, "order_id", "commitment") == [(10, 1), (30, 1)]
    blank = budget.withColumns({"order_id": F.lit(None).cast("bigint"), "order_doc": F.lit("old")})
    assert rows(orders.committed(blank, used), "number", "order_id", "order_doc") == [(1, 10, "00002/20"), (2, None, None), (3, None, None)]


def test_opening_stock_header_and_zero_rows(frame, spark, rows):
    inventory = frame(
        "inventory",
        dict(year=2019, month=12, store=1, material=5, balance=2.0, price=3.0),
        dict(year=2019, month=12, store=1, material=6, balance=0.0, price=3.0),
        dict(year=2019, month=12, store=1, material=4, balance=1.0, price=1.0),
        dict(year=2019, month=11, store=1, material=7, balance=2.0, price=3.0),
    )
    codes = spark.createDataFrame([(5, "c5")], "material bigint, code string")
    tables = stock.opening_stock(inventory, codes, P)
    assert rows(tables["lines"], "item", "code", "total_in", "store") == [(1, "", 1.0, "000000001"), (2, "c5", 6.0, "000000001")]
    assert rows(tables["headers"], "doc", "dated") == [("000000/20", date(2019, 12, 31))]


def test_asset_places_and_values(frame, rows):
    asset = frame("asset", *(dict(number=n, asset_kind=1, writeoff_mode="7") for n in (1, 2, 3)))
    places = frame(
        "asset_placement",
        dict(asset=1, sequence=1, unit=10, movement="A"), dict(asset=1, sequence=2, unit=20, movement="T"),
        dict(asset=2, sequence=1, unit=30, movement="T"),
    )
    values = frame(
        "asset_valuation",
        dict(asset=1, valued=date(2020, 1, 1), base_value=9.0, residual=1.0, revalued=None),
        dict(asset=1, valued=date(2020, 2, 1), base_value=9.0, residual=2.0, revalued="N"),
        dict(asset=3, valued=date(2020, 1, 1), base_value=9.0, residual=4.0, revalued="S"),
    )
    register = assets.assets(asset, places, values, frame("asset_kind", dict(number=1, name="k", account="A1")), P)
    assert rows(register, "asset", "plate", "unit", "current_unit", "residual", "writeoff_code") == [
        (1, "000001", 10, 20, 2.0, 7), (3, "000002", None, None, 4.0, 7)
    ]


def test_closed_asset_is_written_off_at_its_balance(frame, rows):
    asset = frame(
        "asset", dict(number=1, entered=date(2019, 1, 1), closed=date(2020, 6, 1)), dict(number=2, entered=date(2019, 1, 1)),
        dict(number=3, entered=date(2019, 1, 1), closed=date(2020, 7, 1)),
    )
    places = frame("asset_placement", dict(asset=1, sequence=1, unit=10, started=date(2019, 1, 1), movement="A"))
    values = frame(
        "asset_valuation",
        dict(asset=1, valued=date(2019, 1, 1), base_value=100.0, residual=1.0, revalued="N"),
        dict(asset=1, valued=date(2020, 1, 1), base_value=130.0, residual=1.0, revalued="S"),
    )
    worn = frame("depreciation", dict(asset=1, valued=date(2019, 5, 1), value=25.0, month=5, year=2019))
    kinds = frame("asset_kind", dict(number=1))
    moves = assets.ledger(places, values, worn, P)
    assert rows(moves, "movement", "kind", "value", "history") == [
        (1, "A", 100.0, "AQUISICAO"), (2, "R", -25.0, "DEPRECIACAO 5-2019"), (3, "R", 30.0, "REAVALIACAO")
    ]
    balanced = assets.balances(assets.assets(asset, places, values, kinds, P), moves)
    assert rows(balanced, "asset", "current_value", "launched", "accounted") == [
        (1, 105.0, date(2020, 1, 1), date(2020, 1, 1)), (2, 0.0, date(2019, 1, 1), date(2019, 1, 1)),
        (3, 0.0, date(2019, 1, 1), date(2020, 7, 1)),
    ]
    assert rows(assets.writeoffs(balanced, moves), "movement", "asset", "value", "dated") == [
        (4, 1, 105.0, date(2020, 6, 1)), (5, 3, 0.0, date(2020, 7, 1))
    ]
