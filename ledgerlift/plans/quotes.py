"""Quotes: headers, lines, bidders, quoted prices and their totals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.changes import merge_matched, set_from, set_where
from ledgerlift.operators.lookups import lookup
from ledgerlift.operators.picks import first_per_key, matching, summed
from ledgerlift.params import RunParams
from ledgerlift.sources.slices import of_years


def _of_year(quote: DataFrame, params: RunParams) -> DataFrame:
    doc = X.doc_number(F.col("doc_number"), F.col("year"), 5)
    return of_years(quote, "year", params.fiscal_year, params.fiscal_year).withColumn("doc", doc)


def quote_headers(quote: DataFrame, quote_line: DataFrame, params: RunParams) -> DataFrame:
    """One header per quote of the year that has lines."""
    return matching(_of_year(quote, params), quote_line, {"number": "quote"}).select(
        F.col("number").alias("quote"),
        "doc",
        X.pad_grow(F.col("doc_number"), 5).alias("serial"),
        "year",
        "issued",
        X.clean(F.col("subject")).alias("description"),
        X.clean(F.col("subject")).alias("notes"),
        F.lit(0).cast("bigint").alias("centre"),
        F.lit("EC").alias("status"),
        F.lit("S").alias("released"),
        F.lit(params.company).cast("bigint").alias("company"),
        "tender",
    )


def quote_lines(quote: DataFrame, quote_line: DataFrame, items: DataFrame, params: RunParams) -> DataFrame:
    """Quantity per quote, line, material and brand, over all bidders of the line."""
    lines = quote_line.select("quote", "line", "material", "brand", "quantity").join(
        _of_year(quote, params).select(F.col("number").alias("quote"), "doc"), "quote"
    )
    summed = lines.groupBy("quote", "doc", "line", "material", "brand").agg(V.exact_sum(F.col("quantity")).alias("quantity"))
    return lookup(summed, items, {"material": "material"}, ["code"], "fail").select(
        "quote", "doc", "line", "code", "quantity", F.lit(0.0).alias("value"), F.lit(0).cast("bigint").alias("centre")
    )


def quote_bidders(quote: DataFrame, quote_line: DataFrame, person: DataFrame, params: RunParams) -> DataFrame:
    """Each bidder of a quote once, with the name cut to the target column."""
    pairs = quote_line.select("quote", "bidder").distinct()
    named = pairs.join(
        person.select(F.col("number").alias("bidder"), F.substring(F.trim("name"), 1, K.QUOTE_BIDDER_WIDTH).alias("name")), "bidder"
    )
    return (
        named.join(_of_year(quote, params).select(F.col("number").alias("quote"), "doc"), "quote")
        .select("quote", "doc", "bidder", "name", F.lit(0.0).alias("total"))
        .distinct()
    )


def quote_prices(quote: DataFrame, quote_line: DataFrame, params: RunParams) -> DataFrame:
    """Price per bidder and line; the winner's own row also names the winner.

    A row wins when it is flagged as lowest price.  A bidder flagged twice on a
    line counts once, with the lower price.
    """
    docs = _of_year(quote, params).select(F.col("number").alias("quote"), "doc")
    own = ["quote", "line", "bidder"]
    flagged = (
        matching(quote_line, docs, {"quote": "quote"})
        .filter("lowest = 1")
    )
    flagged = summed(flagged, own, F.min("price").alias("won_price")).withColumn("winner", F.col("bidder"))
    return quote_line.join(docs, "quote").join(flagged, own, "left").select(
        "quote", "doc", "bidder", "line",
        F.col("price").alias("unit_price"),
        (F.col("quantity") * F.col("price")).alias("total"),
        F.lit("GL").alias("price_class"),
        "brand", "winner", "won_price",
    )


def quote_totals(bidders: DataFrame, prices: DataFrame) -> DataFrame:
    """Bidders with the sum of their prices; NULL for a bidder without prices."""
    totals = summed(prices, ["quote", "bidder"], V.exact_sum(F.col("total")).alias("sum_total"))
    return set_from(bidders, totals, {"quote": "quote", "bidder": "bidder"}, "total", "sum_total")


def quote_awards(lines: DataFrame, prices: DataFrame) -> DataFrame:
    """Lines with their winner, winning price and total.

    One winner per line: the lowest winning price, then the lowest bidder.  A
    line without winner gets price 0 and keeps its NULL total, as the total is
    computed from the price before it is set.
    """
    winners = first_per_key(
        prices.filter(F.col("winner").isNotNull()),
        ["quote", "line"],
        [F.col("won_price").asc_nulls_last(), F.col("winner").asc()],
    )
    blank = lines.select(
        "quote", "line", "code", "quantity",
        F.lit(None).cast("bigint").alias("winner"), F.lit(None).cast("double").alias("unit_price"),
    )
    awarded = merge_matched(
        blank, winners, {"quote": "quote", "line": "line"}, {"winner": "winner", "unit_price": "won_price"}
    )
    priced = awarded.withColumns({
        "total": F.col("unit_price") * F.col("quantity"), "kind": F.lit("M"), "accepted": F.lit("S"),
    })
    open_rows = F.col("unit_price").isNull() | F.col("total").isNull()
    return set_where(
        priced, open_rows, {"total": F.col("unit_price") * F.col("quantity"), "unit_price": F.lit(0.0)}
    )
