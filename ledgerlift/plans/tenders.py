"""Tenders: headers, bidders, items, bids, awards, price register and amendments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.changes import absent_rows, merge_matched, set_from_where
from ledgerlift.operators.lookups import found_or_fail, lookup, misses
from ledgerlift.operators.numbering import number_all, number_within
from ledgerlift.operators.picks import best_with_ties, first_per_key, latest_value, matching, summed, unmatched
from ledgerlift.params import RunParams
from ledgerlift.sources.slices import of_years


def _long(value) -> F.Column:
    return F.lit(value).cast("bigint")


def modality_list(spark) -> DataFrame:
    return spark.createDataFrame(K.MODALITIES, K.MODALITY_SCHEMA)


MODALITY = {"modality": "modality"}


def known_tenders(tender: DataFrame) -> DataFrame:
    """The keys (``tender``) of tenders that get a header: those of a known modality."""
    fixed = modality_list(tender.sparkSession)
    return matching(tender, fixed, MODALITY, unique=True).select(F.col("number").alias("tender"))


def clock(text) -> F.Column:
    """``HHMM`` of a time of day, with or without colons; an hour of one digit before a colon gets its zero."""
    whole = F.when(text.rlike("^[0-9]:"), F.concat(F.lit("0"), text)).otherwise(text)
    return F.substring(F.replace(whole, F.lit(":"), F.lit("")), 1, 4)


def by_tender(rows: DataFrame) -> DataFrame:
    """Rows placed by their tender alone.

    Joins and groups on keys that include the tender need no further shuffle where all their sides are placed so; the rows
    of one tender meet in one task.
    """
    return rows.repartition("tender")


# ---- headers ---------------------------------------------------------------------


def tenders(tender: DataFrame, modality_names: DataFrame, params: RunParams) -> dict[str, DataFrame]:
    """Tender headers with their number within the year and their modality.

    Tenders of an unknown modality go to the reject frame.  ``modality_names``
    holds the target's own name per modality code and wins over the fixed list.
    """
    # Only the sort columns are numbered and go through scratch.
    numbers = number_within(
        tender.select("number", "year", "process_number"), ["year"],
        [F.col("process_number").asc_nulls_last(), F.col("number").asc()], "n",
    ).select("number", "n")
    fixed = modality_list(tender.sparkSession)
    known = lookup(tender.join(numbers, "number"), fixed, MODALITY, ["modality_name", "short_code", "modality_code"], "skip")
    headers = known.select(
        F.col("number").alias("tender"),
        X.doc_number(F.col("n"), F.col("year"), 6).alias("sequence"),
        X.doc_number(F.col("process_number"), F.col("year"), 6).alias("process"),
        F.col("doc_number").alias("doc"),
        "year",
        _long(3).alias("mode"),
        _long(1).alias("new_rules"),
        F.lit("S").alias("released"),
        X.clean(F.col("subject"), K.SUBJECT_WIDTH).alias("description"),
        X.clean(F.col("subject")).alias("detail"),
        "price_register",
        _long(0).alias("small_firms"),
        "process_number",
        F.lit(K.UNIT_PRICE_CRITERION).alias("criterion"),
        "dated",
        F.col("opened").alias("proposals_opened"),
        clock(F.col("open_time")).alias("open_time"),
        clock(F.col("delivery_time")).alias("delivery_time"),
        F.lit(K.OTHER_PUBLICATION).alias("publication"),
        "approved",
        F.substring("office", 1, K.OFFICE_WIDTH).alias("office"),
        "external_code",
        "short_code",
        "modality_name",
        F.col("modality_code").cast("bigint").alias("modality_code"),
        "published",
        "closed",
        clock(F.col("close_time")).alias("close_time"),
        "amount",
        _long(params.company).alias("company"),
    )
    named = merge_matched(headers, modality_names, {"modality_code": "code"}, {"modality_name": "name"})
    return {"tenders": named, "rejected": misses(tender, fixed, MODALITY)}


def modality_register(headers: DataFrame) -> DataFrame:
    """Last process number per modality, year and company, under an own id."""
    keys = ["modality_code", "year", "company"]
    register = (
        headers.filter(F.col("modality_code").isNotNull())
        .groupBy("modality_code", F.coalesce("year", _long(0)).alias("year"), "company")
        .agg(F.coalesce(F.max("process_number"), _long(0)).alias("last_number"))
    )
    return number_all(register, [F.col(k).asc_nulls_last() for k in keys], "register")


def with_register(headers: DataFrame, register: DataFrame) -> DataFrame:
    """Tender headers with the id of their register row."""
    keys = {k: k for k in ("modality_code", "year", "company")}
    blank = headers.withColumn("register", F.lit(None).cast("bigint"))
    return set_from_where(blank, register, keys, "register", "register", F.col("modality_code").isNotNull())


def sessions(headers: DataFrame, existing: DataFrame) -> DataFrame:
    """First session of tenders that have none yet."""
    return unmatched(headers, existing, {"tender": "tender"}).select(
        "tender", _long(1).alias("session"), F.col("dated").alias("held"), "delivery_time", "mode", "closed", "close_time",
        F.lit("T").alias("session_for"), F.lit("O").alias("reason"),
    )


def tender_bidders(tender_bidder: DataFrame, person: DataFrame, tender: DataFrame) -> dict[str, DataFrame]:
    """Bidders of known tenders and their entry in the first session."""
    named = tender_bidder.join(
        person.select(F.col("number").alias("bidder"), X.clean(F.col("name"), K.BIDDER_WIDTH).alias("name")), "bidder"
    )
    rows = matching(named, tender, {"tender": "number"}, unique=True)
    return {
        "bidders": rows.select("tender", "bidder", "name", F.lit("A").alias("status")),
        "session_bidders": rows.select(
            _long(1).alias("session"), "tender", "bidder", F.lit("S").alias("enabled"), F.lit("A").alias("status"),
            "tax_id", X.clean(F.col("representative"), K.BIDDER_WIDTH).alias("representative"),
        ),
    }


def unknown_bidders(tender_bidder: DataFrame, person: DataFrame, tender: DataFrame) -> DataFrame:
    """Reject frame: bidders of an unknown tender or without person."""
    named = matching(tender_bidder, person, {"bidder": "number"}, unique=True)
    unnamed = misses(tender_bidder, person, {"bidder": "number"})
    return unnamed.unionByName(misses(named, tender, {"tender": "number"}))


# ---- items ------------------------------------------------------------------------


def open_offers(
    tender_offer: DataFrame, catalog_item: DataFrame, tender_item: DataFrame, tender: DataFrame, codes: DataFrame | None = None
) -> DataFrame:
    """Offers on known materials and on items that are no annex, one row per such item.

    With the coded catalog items ``codes`` they have the ``code`` of their material and whether it is ``coded``.  The items
    are then by their materials once, and offers and what is made of them stay by tender (see :func:`by_tender`), if
    written by :func:`ledgerlift.session.written_by`.
    """
    items = tender_item.filter("annex = 'N'").select("tender", "material", "failed")
    known = matching(items, catalog_item, {"material": "number"}, unique=True)
    if codes is None:
        # The narrow items are looked up, not the offers, which meet them on the same keys and go through one shuffle.
        return tender_offer.join(matching(known, tender, {"tender": "number"}, unique=True), ["tender", "material"])
    coded = lookup(known, codes.withColumn("coded", F.lit(True)), {"material": "material"}, ["code", "coded"], "null")
    offers = matching(by_tender(tender_offer), tender, {"tender": "number"}, unique=True)
    return offers.join(by_tender(coded), ["tender", "material"])


def best_offers(offers: DataFrame, tender_item_avg: DataFrame) -> DataFrame:
    """Lowest offer per tender line with the number of offers and the item's average price.

    ``avg_material`` is NULL for an item without average.
    """
    # One pre-aggregated pass gives both; a struct compares field by field, unpriced offers last.
    code = [c for c in ("code", "coded") if c in offers.columns]  # follow from the material
    lowest = F.struct(
        F.col("unit_price").isNull().alias("unpriced"), "unit_price", "material", "bidder", "quantity", "offer", "failed", *code
    )
    best = (
        offers.groupBy("tender", "line")
        .agg(F.min(lowest).alias("best"), F.count("*").alias("offers"))
        .select("tender", "line", "offers", "best.*")
    )
    average = tender_item_avg.select(
        "tender", "material", F.col("material").alias("avg_material"), "avg_price", F.col("total").alias("avg_total")
    )
    on = {"tender": "tender", "material": "material"}
    return lookup(best, average, on, ["avg_material", "avg_price", "avg_total"], "null")


def tender_items(best: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Tender items with the code of their material, from the coded catalog ``items`` unless the offers have it already.

    An item without average price has no material and stops the run.
    """
    if items is None:
        hit = F.col("coded") & F.col("avg_material").isNotNull()
        coded = found_or_fail(best, hit, ["avg_material"], ["code"])
    else:
        coded = lookup(best, items, {"avg_material": "material"}, ["code"], "fail")
    return coded.select(
        "tender", "line", F.col("avg_material").alias("material"), "code", "quantity", "avg_price",
        F.col("avg_total").alias("total"), "offers", F.lit("C").alias("kind"), _long(0).alias("centre"),
        F.lit("N").alias("reduced"), F.lit(K.DEFAULT_LOT).alias("lot"), "failed",
    )


def item_details(items: DataFrame) -> DataFrame:
    return items.select("tender", "line", "code", "quantity", "avg_price", "total", "centre", F.col("line").alias("item"))


def item_funding(items: DataFrame) -> DataFrame:
    return items.select(
        "tender", "line", F.col("line").alias("code"), "quantity", F.col("total").alias("value"),
        F.col("quantity").alias("added_quantity"), F.col("total").alias("added_value"), "centre", "kind",
    )


def lots(items: DataFrame, existing: DataFrame) -> DataFrame:
    rows = items.filter(F.col("lot").isNotNull()).select(
        X.join_strict(F.lit(K.LOT_LABEL), F.col("lot")).alias("description"), "lot", "tender"
    )
    return absent_rows(rows.distinct(), existing, {"tender": "tender", "lot": "lot"})


def item_status(items: DataFrame, headers: DataFrame, existing: DataFrame) -> DataFrame:
    """Closing screen of every item of a known tender that has no status yet."""
    known = matching(items, headers, {"tender": "tender"}, unique=True)
    return absent_rows(known, existing, {"tender": "tender", "line": "line"}).select(
        "tender", _long(1).alias("session"), "line", F.lit(K.CLOSED_SCREEN).alias("screen")
    )


# ---- bids --------------------------------------------------------------------------


def bids_rounds(bid_round: DataFrame, items: DataFrame, once: bool = False) -> DataFrame:
    """Each bidder's bids of the last round, on every tender item that carries the material.

    With ``once`` the rounds go through one shuffle, by tender, and the last ones are found in their place.
    """
    last = best_with_ties(by_tender(bid_round), ["tender", "bidder", "material"], "round", placed=once)
    lines = items.select(
        "tender", "material", "line", "quantity", "code", F.when(F.col("failed") == "S", "D").otherwise("C").alias("status")
    )
    return _bid(last.join(lines, ["tender", "material"]).select(
        "tender", "bidder", "line", "code", "quantity", F.col("price").alias("unit_price"),
        (F.col("quantity") * F.col("price")).alias("total"), "status",
        F.when(F.col("winner") == "S", 1).otherwise(0).cast("bigint").alias("won"),
        F.lit(None).cast("string").alias("brand"), F.col("round").cast("bigint").alias("round"),
    ))


def bids_direct(
    offers: DataFrame, tender: DataFrame, bid_round: DataFrame, items: DataFrame | None, params: RunParams
) -> DataFrame:
    """Winning offers of the last years on materials that had no bidding rounds.

    ``items`` are the coded catalog items, or None where offers have their code; an unknown material stops the run.
    """
    recent = of_years(tender, "year", params.fiscal_year - params.direct_bid_years)
    won = matching(offers.filter("lowest = 1"), recent, {"tender": "number"}, unique=True)
    direct = unmatched(won, by_tender(bid_round), {"tender": "tender", "material": "material"})
    if items is None:
        coded = found_or_fail(direct, F.col("coded"), ["material"], ["code"])
    else:
        coded = lookup(direct, items, {"material": "material"}, ["code"], "fail")
    return _bid(coded.select(
        "tender", "bidder", "line", "code", "quantity", "unit_price", "total", F.lit("C").alias("status"),
        _long(1).alias("won"), F.lit(None).cast("string").alias("brand"), _long(1).alias("round"),
    ))


def _bid(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "session": _long(1), "item_bid": F.lit("S"), "lot": F.lit(K.DEFAULT_LOT),
        "control": V.control_kind(F.col("quantity")), "amended_quantity": F.col("quantity"),
        "amended_price": F.col("unit_price"),
    })


BID_KEYS = {"tender": "tender", "line": "line", "bidder": "bidder"}


def one_round(rounds: DataFrame) -> DataFrame:
    """Of tied winning rounds of a bidder on a line the one with the lowest price, then the lowest total."""
    return first_per_key(rounds, list(BID_KEYS), [F.col("unit_price").asc_nulls_last(), F.col("total").asc_nulls_last()])


def tied_rounds(rounds: DataFrame) -> DataFrame:
    """Audit frame: keys with more than one winning round, and how many rounds they have."""
    won = rounds.filter("won = 1 AND status = 'F'")
    return won.groupBy(*BID_KEYS).agg(F.count("*").alias("rounds"), F.min("unit_price").alias("kept_price")).filter("rounds > 1")


def winning_rounds(bids: DataFrame, existing: DataFrame) -> DataFrame:
    return absent_rows(bids.filter("won = 1"), existing, BID_KEYS).select(
        "session", _long(1).alias("round"), "bidder", "line", "unit_price", "total", F.lit("F").alias("status"), "won", "tender"
    )


def final_bids(bids: DataFrame, existing: DataFrame) -> DataFrame:
    status = F.when(F.col("status") == "F", "C").otherwise(F.col("status"))
    return absent_rows(bids, existing, BID_KEYS).select(
        "tender", F.col("session").alias("last_session"), "bidder", "line", "unit_price", "total", status.alias("status"), "won"
    )


# ---- awards -----------------------------------------------------------------------------


def awards(
    rounds: DataFrame, status: DataFrame, details: DataFrame, headers: DataFrame, bids: DataFrame, existing: DataFrame
) -> DataFrame:
    """Awarded items: finished winning rounds with the quantity that follows from total and price.

    A bidder wins a line once, see :func:`one_round`; the brand is that of one of its bids (the lowest).
    """
    won = one_round(rounds.filter("won = 1 AND status = 'F'")).select(
        "tender", "line", "session", "bidder", "unit_price", "total"
    )
    known = matching(won, status, {"tender": "tender", "line": "line", "session": "session"}, unique=True)
    known = matching(known, headers, {"tender": "tender"}, unique=True)
    detailed = known.join(
        details.select("tender", F.col("item").alias("line"), "code", "centre"), ["tender", "line"]
    ).join(summed(bids, list(BID_KEYS), F.min("brand").alias("brand")), list(BID_KEYS))
    rows = absent_rows(detailed, existing, BID_KEYS)
    quantity = V.safe_ratio(F.col("total"), F.col("unit_price"))
    return rows.withColumn("quantity", quantity).select(
        "tender", "line", "bidder", "code", "centre", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("total"),
        _long(1).alias("won"), F.lit("C").alias("status"), _long(1).alias("last_session"),
        F.col("quantity").alias("amended_quantity"),
        F.col("unit_price").alias("amended_price"),
        (F.col("quantity") * F.col("unit_price")).alias("amended_total"),
        F.lit("Q").alias("control"), "brand",
    )


PRICE_KEYS = {k: k for k in ("tender", "bidder", "code", "centre", "line")}


def price_register(headers: DataFrame, award: DataFrame, existing: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Documents, prices and history of the price register that ``existing`` lacks, valid one year after approval.

    Made for the tables named in ``existing``.
    """
    approved = headers.filter("price_register = 'S' AND approved IS NOT NULL").select(
        "tender", V.one_year_later(F.col("approved")).alias("valid_until")
    )
    rows = award.join(approved, "tender")
    version, last = _long(0).alias("version"), F.lit("S").alias("last")
    common = ["tender", "bidder", "code", "centre", "line", version, "quantity", "unit_price", "total", "won", "status"]
    wanted = {
        "register_docs": (approved.distinct(), {"tender": "tender"}, ["tender", version, "valid_until", last]),
        "register_prices": (rows, PRICE_KEYS, [*common, "valid_until", F.lit(0.0).alias("delivered"), last]),
        "register_history": (rows, PRICE_KEYS, [*common, "brand", last]),
    }
    return {
        name: absent_rows(found, existing[name], keys).select(*columns)
        for name, (found, keys, columns) in wanted.items() if name in existing
    }


# ---- amendments ----------------------------------------------------------------------------


ITEM = {"tender": "tender", "material": "material"}


def _lines_of(items: DataFrame) -> DataFrame:
    return summed(items, ["tender", "material"], F.min("line").alias("line"))


def amended_quantities(request: DataFrame, request_line: DataFrame, request_tender: DataFrame) -> DataFrame:
    """Quantity added by amendment requests per tender and material."""
    amended_requests = request.filter("type = 2").select(F.col("number").alias("request"))
    return (
        request_line.join(amended_requests, "request")
        .join(request_tender, "request")
        .groupBy("tender", "material")
        .agg(F.coalesce(V.exact_sum(F.col("quantity")), F.lit(0.0)).alias("added"))
    )


def amended_prices(price_adjustment: DataFrame) -> DataFrame:
    """The latest price per tender and material."""
    return latest_value(
        price_adjustment, ["tender", "material"], "unit_price",
        [F.col("starts").desc_nulls_first(), F.col("unit_price").asc()],
    ).withColumnRenamed("unit_price", "new_price")


def amendment_rejects(
    items: DataFrame, request: DataFrame, request_line: DataFrame, request_tender: DataFrame, price_adjustment: DataFrame
) -> DataFrame:
    """Reject frame: amendments of a (tender, material) that is no tender item."""
    line_of = _lines_of(items)
    quantities = misses(amended_quantities(request, request_line, request_tender), line_of, ITEM)
    prices = misses(amended_prices(price_adjustment), line_of, ITEM)
    return quantities.withColumn("new_price", F.lit(None).cast("double")).unionByName(
        prices.withColumn("added", F.lit(None).cast("double")))


def amendments(
    award: DataFrame,
    items: DataFrame,
    request: DataFrame,
    request_line: DataFrame,
    request_tender: DataFrame,
    price_adjustment: DataFrame,
    on_miss: str = "fail",
) -> DataFrame:
    """Awards with the quantities of amendment requests added and the latest price set.

    Amendments name a material; a (tender, material) that is no tender item
    stops the run, or is left out with ``on_miss="skip"``.  A material under
    several items of a tender changes the lowest one.
    """
    line_of = _lines_of(items)
    extra = lookup(amended_quantities(request, request_line, request_tender), line_of, ITEM, ["line"], on_miss, unique=True)
    price = lookup(amended_prices(price_adjustment), line_of, ITEM, ["line"], on_miss, unique=True)

    keys = {"tender": "tender", "line": "line"}
    base = award.withColumns({
        "amended_quantity": F.col("quantity"), "amended_price": F.col("unit_price"), "amended_total": F.col("total"),
    })
    more = lookup(base, extra, keys, ["added"], "null")
    grown = F.col("quantity") + F.col("added")
    hit = (F.col("won") == 1) & F.col("added").isNotNull()
    more = more.withColumns({
        "amended_total": F.when(hit, grown * F.col("unit_price")).otherwise(F.col("amended_total")),
        "amended_quantity": F.when(hit, grown).otherwise(F.col("amended_quantity")),
    })
    priced = lookup(more, price, keys, ["new_price"], "null")
    hit = (F.col("won") == 1) & F.col("new_price").isNotNull()
    return priced.withColumns({
        "amended_price": F.when(hit, F.col("new_price")).otherwise(F.col("amended_price")),
        "amended_total": F.when(hit, F.col("amended_quantity") * F.col("new_price")).otherwise(F.col("amended_total")),
    }).select(*award.columns)
