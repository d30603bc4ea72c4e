"""Opening stock and stock movements."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.lookups import lookup
from ledgerlift.operators.numbering import number_all
from ledgerlift.operators.picks import first_per_key
from ledgerlift.params import RunParams
from ledgerlift.session import written
from ledgerlift.sources.slices import of_years


def _opening_doc(params: RunParams) -> str:
    return f"{K.OPENING_SERIAL}/{params.fiscal_year % 100:02d}"


def is_opening(doc):
    """Documents of the opening stock, in either direction of a slice refresh."""
    return F.lower(doc).contains(f"{K.OPENING_SERIAL}/".lower())


def opening_stock(inventory: DataFrame, items: DataFrame, params: RunParams) -> dict[str, DataFrame]:
    """The December inventory of the year before as document 0; unknown materials keep an empty code."""
    company = F.lit(params.company).cast("bigint")
    rows = of_years(inventory, "year", params.fiscal_year - 1, params.fiscal_year - 1).filter(
        (F.col("month") == 12) & (F.col("balance") * F.col("price") != 0)
    )
    numbered = number_all(rows, [F.col("material").asc(), F.col("store").asc()], "item")
    coded = lookup(numbered, items, {"material": "material"}, ["code"], "blank")
    zero = F.lit(0.0)
    lines = coded.select(
        F.lit(0).cast("bigint").alias("document"), F.lit(_opening_doc(params)).alias("doc"),
        F.lit(0).cast("bigint").alias("centre"), company.alias("company"), "item",
        F.col("balance").alias("quantity_in"), zero.alias("quantity_out"), F.col("price").alias("price_in"),
        zero.alias("price_out"), (F.col("balance") * F.col("price")).alias("total_in"), zero.alias("total_out"),
        "code", X.pad_grow(F.col("store"), 9).alias("store"),
    )
    last_day = F.make_date(F.lit(params.fiscal_year - 1), F.lit(12), F.lit(31))
    header = inventory.sparkSession.range(1).select(
        company.alias("company"), F.lit(0).cast("bigint").alias("document"), F.lit(_opening_doc(params)).alias("doc"),
        F.lit(K.OPENING_SERIAL).alias("serial"), F.lit(params.fiscal_year).cast("bigint").alias("year"),
        F.lit(K.OPENING_STORE).alias("store"), F.lit(0).cast("bigint").alias("centre"), last_day.alias("dated"),
        last_day.alias("entered"), F.lit(None).cast("date").alias("paid"), F.lit("S").alias("inbound"),
        F.lit("N").alias("outbound"), F.lit("P").alias("kind"), F.lit(None).cast("bigint").alias("supplier"),
        F.lit(None).cast("string").alias("passes_through"),
    )
    return {"headers": header, "lines": lines}


def in_scope(movement: DataFrame, params: RunParams) -> DataFrame:
    """Movements dated in the year or of the fiscal year, with ``dated_in`` and ``own`` telling which."""
    dated_in = F.coalesce(V.in_year(F.col("issued"), params.fiscal_year), F.lit(False))
    own = F.coalesce(F.col("year") == params.fiscal_year, F.lit(False))
    return movement.filter(V.in_year(F.col("issued"), params.fiscal_year) | (F.col("year") == params.fiscal_year)).select(
        F.col("number").alias("movement"), "year", "issued", "store", "supplier", dated_in.alias("dated_in"), own.alias("own")
    )


def unflagged(movement: DataFrame, movement_line: DataFrame, params: RunParams) -> DataFrame:
    """Reject frame: lines of the year's movements whose direct flag is unknown."""
    lines = movement_line.filter(F.col("direct").isNull()).select("movement", "line", "material", "quantity", "total")
    return lines.join(in_scope(movement, params).select("movement", "year", "issued"), "movement")


def unflagged_requests(stock_request: DataFrame, params: RunParams) -> DataFrame:
    """Reject frame: requests of the year whose direct flag is unknown."""
    return of_years(stock_request, "year", params.fiscal_year, params.fiscal_year).filter(F.col("direct").isNull())


def expected(
    movement: DataFrame, movement_line: DataFrame, stock_request: DataFrame, stock_request_line: DataFrame, params: RunParams
) -> DataFrame:
    """How many lines (``_n``, by document) the year should have, unknown flags included, from counts of lines per document."""
    direct, known = F.col("direct") == "S", F.col("direct").isNotNull()
    lines = movement_line.groupBy(F.col("movement").alias("_key")).agg(
        F.count_if(direct).alias("direct_lines"), F.count_if(~direct).alias("own_lines"), F.count_if(~known).alias("open_lines")
    )
    heads = in_scope(movement, params)
    wanted = (
        F.when(F.col("dated_in"), F.col("direct_lines")).otherwise(0) + F.when(F.col("own"), F.col("own_lines")).otherwise(0)
        + F.col("open_lines")
    )
    asked = stock_request_line.groupBy(F.col("request").alias("_key")).agg(F.count("*").alias("_n"))
    requests = of_years(stock_request, "year", params.fiscal_year, params.fiscal_year).filter("direct <> 'S'").select("number")
    return heads.join(lines, F.col("movement") == F.col("_key")).select(wanted.cast("bigint").alias("_n")).unionByName(
        requests.join(asked, F.col("number") == F.col("_key")).select("_n")
    )


def movement_rows(
    movement: DataFrame, movement_line: DataFrame, stock_request: DataFrame, stock_request_line: DataFrame, params: RunParams
) -> DataFrame:
    """Lines of direct deliveries (X), entries (E) and issues (S) with what their document says; each source is read once."""
    year = params.fiscal_year
    lines = movement_line.select("movement", "line", "material", "quantity", "unit_price", "total", "direct")

    def branch(rows, kind, centre, dated, entered, paid, supplier, price, total):
        return rows.select(
            F.col("movement").alias("number"), kind.alias("move"), "year", X.pad_grow(F.col("store"), 9).alias("store"),
            centre.alias("centre"), dated.alias("dated"), entered.alias("entered"), paid.alias("paid"),
            supplier.alias("supplier"), F.col("line").alias("item"), "material", "quantity", price.alias("unit_price"),
            total.alias("total"),
        )

    no_day, issued, direct = F.lit(None).cast("date"), F.col("issued"), F.col("direct") == "S"
    # Direct deliveries may be dated in the year and belong to another.
    moved = in_scope(movement, params).join(lines, "movement").filter((direct & F.col("dated_in")) | (~direct & F.col("own")))
    requests = (
        of_years(stock_request, "year", year, year).filter(F.col("direct") != "S")
        .withColumnRenamed("number", "movement")
        .join(stock_request_line.withColumnRenamed("request", "movement"), "movement")
    )
    return branch(
        moved, F.when(direct, "X").otherwise("E"), F.lit(0).cast("bigint"), issued, issued, F.when(direct, issued),
        F.col("supplier"), F.col("unit_price"), F.col("total"),
    ).unionByName(branch(
        requests, F.lit("S"), F.col("unit"), no_day, issued, issued, F.lit(None).cast("bigint"), F.lit(0.0), F.lit(0.0)
    ))


def stock_movements(
    movement: DataFrame,
    movement_line: DataFrame,
    stock_request: DataFrame,
    stock_request_line: DataFrame,
    items: DataFrame,
    params: RunParams,
) -> dict[str, DataFrame]:
    """Direct deliveries (X), entries (E) and issues (S) of the year as documents under new numbers.

    Direct deliveries count by document date, the others by fiscal year.  A
    line or request whose direct flag is unknown belongs to none of the kinds
    (see :func:`unflagged`).  The joined rows are written once; documents are
    numbered once, and both targets read these two tables.
    """
    rows = written(movement_rows(movement, movement_line, stock_request, stock_request_line, params), "stock-rows")
    order = [F.col(c).asc_nulls_last() for c in ("item", "material", "quantity", "unit_price", "store", "centre")]
    first = first_per_key(rows, ["number", "move"], order).drop("item", "material", "quantity", "unit_price", "total")
    documents = number_all(first, [F.col("number").asc_nulls_last(), F.col("move").asc_nulls_last()], "document").withColumns({
        "company": F.lit(params.company).cast("bigint"),
        "doc": X.doc_number(F.col("document"), F.col("year"), 6),
        "serial": X.pad_grow(F.col("document"), 6),
    })
    move = F.col("move")
    headers = documents.select(
        "company", "document", "doc", "serial", "year", "store", "centre", "dated", "entered", "paid",
        F.when(move == "S", "N").otherwise("S").alias("inbound"),
        F.when(move == "E", "N").otherwise("S").alias("outbound"),
        F.lit("P").alias("kind"), "supplier",
        F.when(move == "X", "S").otherwise("N").alias("passes_through"),
    )
    numbered = rows.join(documents.select("number", "move", "document", "company"), ["number", "move"])
    numbered = numbered.withColumn("doc", X.doc_number(F.col("document"), F.col("year"), 6))
    coded = lookup(numbered, items, {"material": "material"}, ["code"], "blank")
    amounts = {"quantity": "quantity", "price": "unit_price", "total": "total"}
    sides = {"in": "S", "out": "E"}  # the kind that has nothing on this side
    return {
        "headers": headers,
        "lines": coded.select(
            "document", "doc", "centre", "company", "item",
            *(
                F.when(move == empty, F.lit(0.0)).otherwise(F.col(column)).alias(f"{name}_{side}")
                for name, column in amounts.items()
                for side, empty in sides.items()
            ),
            "code", "store",
        ),
    }
