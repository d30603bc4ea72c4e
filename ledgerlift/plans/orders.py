"""Purchase orders of the year, their commitments and the balance of earlier years."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.changes import set_from, set_from_where, set_if_exists
from ledgerlift.operators.lookups import lookup, misses
from ledgerlift.operators.numbering import anew
from ledgerlift.operators.picks import first_by, matching, summed
from ledgerlift.params import RunParams
from ledgerlift.sources.slices import of_years


def _annulled(order_annulment: DataFrame) -> DataFrame:
    """Annulments per order line; a line can be annulled more than once."""
    return summed(
        order_annulment, ["order_id", "line"],
        V.exact_sum(F.col("quantity")).alias("annulled_quantity"), V.exact_sum(F.col("value")).alias("annulled_value"),
    )


def order_headers(
    purchase_order: DataFrame, order_line: DataFrame, price_register_tenders: DataFrame, params: RunParams, numbers=anew
) -> DataFrame:
    """Orders of the year that have lines, renumbered from 1; ``numbers`` gives the numbers, anew or from a register.

    The order is the document number and, where a number was issued again, the
    order id.  Carries the new number of the parent order, and marks orders of
    price-register tenders.
    """
    own = of_years(purchase_order, "year", params.fiscal_year, params.fiscal_year)
    own = matching(own, order_line, {"number": "order_id"})
    # Only the sort columns are numbered and go through scratch.
    given = numbers(
        f"orders/{params.fiscal_year}", own.select("number", "doc_number"), ["number"],
        [F.col("doc_number").asc_nulls_last(), F.col("number").asc()],
    ).select("number", "n")
    numbered = own.join(given, "number")
    doc = X.doc_number(F.col("n"), F.col("year"), 5)
    contract = F.concat(X.pad_grow(F.col("contract_number"), 4), F.lit("/"), X.short_year(F.col("contract_year")))
    headers = numbered.select(
        F.col("number").alias("order_id"),
        doc.alias("doc"),
        X.doc_serial(doc).alias("serial"),
        "year", "supplier", "issued", "budget_line", "unit",
        F.lit("S").alias("delivered"),
        "tender", "delivery_place", "payment_terms", "notes",
        F.lit(params.company).cast("bigint").alias("company"),
        contract.alias("contract"),
        F.col("parent").alias("parent_order"),
        F.lit(None).cast("string").alias("parent_doc"),
        F.lit(None).cast("bigint").alias("register_version"),
        F.when(F.col("sub_number") == 0, F.col("commitment")).alias("commitment"),
        "expense_category", "expense_group", "expense_modality", "expense_element", "expense_detail", "link_group",
        X.pad_signed(F.col("link_code"), 3).alias("link_code"),
        X.pad_grow(F.col("store"), 9).alias("store"),
    )
    year = F.lit(params.fiscal_year)
    issued = given.select(F.col("number").alias("known_order_id"), X.doc_number(F.col("n"), year, 5).alias("known_doc"))
    linked = set_from_where(
        headers, issued, {"parent_order": "known_order_id"}, "parent_doc", "known_doc", F.col("parent_order").isNotNull()
    )
    return set_if_exists(
        linked, price_register_tenders, {"tender": "tender"}, {"register_version": F.lit(0).cast("bigint")}
    )


def order_lines(headers: DataFrame, order_line: DataFrame, order_annulment: DataFrame, items: DataFrame) -> DataFrame:
    """Lines under their header's new number, with the quantities annulled."""
    heads = headers.select(
        "order_id", "doc", "unit", "budget_line", "expense_category", "expense_group", "expense_modality",
        "expense_element", "expense_detail", "link_group", "link_code", "store",
    )
    lines = order_line.join(heads, "order_id").join(_annulled(order_annulment), ["order_id", "line"], "left")
    return lookup(lines, items, {"material": "material"}, ["code"], "fail").select(
        "doc", "order_id", "line", "code", F.col("unit").alias("centre"), "quantity", "unit_price", "total",
        *heads.columns[3:], "annulled_quantity", "annulled_value",
    )


def order_commitments(headers: DataFrame, commitment: DataFrame) -> DataFrame:
    """Orders with a budget commitment of a non-zero open amount."""
    open_amounts = commitment.filter("carried_year IS NULL AND amount > 0")
    funded = lookup(
        headers.filter(F.col("commitment").isNotNull()), open_amounts, {"commitment": "number"}, ["amount"], "zero"
    )
    return funded.filter("amount <> 0").select(
        "doc", "budget_line", "amount", "expense_category", "expense_group", "expense_modality", "expense_element",
        "expense_detail", F.lit(0).cast("bigint").alias("code"), "order_id", "commitment",
    )


def committed(commitment: DataFrame, order_commitment: DataFrame) -> DataFrame:
    """Commitments with the order that uses them (the lowest), NULL where none does."""
    first = first_by(order_commitment, ["commitment"], ["order_id"], ["order_id", "doc"])
    keys = {"number": "commitment"}
    linked = set_from(commitment, first, keys, "order_id", "order_id", unique=True)
    return set_from(linked, first, keys, "order_doc", "doc", unique=True)


TENDER_LINE = {"tender": "tender", "code": "code"}


def ordered_before(
    purchase_order: DataFrame, order_line: DataFrame, order_annulment: DataFrame, items: DataFrame, params: RunParams
) -> DataFrame:
    """Quantity and value ordered before the year per tender and item code, net of annulments.

    Annulments are summed per line first, so that a line annulled twice still counts once.
    """
    earlier = of_years(purchase_order, "year", last=params.fiscal_year - 1)
    earlier = earlier.filter(F.col("parent").isNull() & F.col("tender").isNotNull()).select(F.col("number").alias("order_id"), "tender")
    lines = order_line.join(earlier, "order_id").join(_annulled(order_annulment), ["order_id", "line"], "left")
    value = V.exact_sum(F.col("total")) - V.exact_sum(F.coalesce("annulled_value", F.lit(0.0)))
    quantity = V.exact_sum(F.col("quantity")) - V.exact_sum(F.coalesce("annulled_quantity", F.lit(0.0)))
    net = lines.groupBy("tender", "material").agg(quantity.alias("quantity"), value.alias("value"))
    return lookup(net, items, {"material": "material"}, ["code"], "fail")


def _tender_lines(tender_items: DataFrame) -> DataFrame:
    return first_by(tender_items, ["tender", "code"], ["line"], ["line"])


def placed_balance(net: DataFrame, tender_items: DataFrame, params: RunParams) -> DataFrame:
    """``net`` on the lines of its tenders; what is no item of its tender is left out (see :func:`unplaced_balance`)."""
    return lookup(net, _tender_lines(tender_items), TENDER_LINE, ["line"], "skip", unique=True).select(
        F.lit(params.fiscal_year - 1).cast("bigint").alias("year"), "tender", "line", "code", "quantity", "value"
    )


def unplaced_balance(net: DataFrame, tender_items: DataFrame) -> DataFrame:
    """Reject frame: rows of ``net`` whose code is no item of its tender."""
    return misses(net, _tender_lines(tender_items), TENDER_LINE)


def prior_balance(
    purchase_order: DataFrame,
    order_line: DataFrame,
    order_annulment: DataFrame,
    tender_items: DataFrame,
    items: DataFrame,
    params: RunParams,
) -> DataFrame:
    """Balance of earlier years per tender item."""
    return placed_balance(ordered_before(purchase_order, order_line, order_annulment, items, params), tender_items, params)


def register_balance(balance: DataFrame, price_register_tenders: DataFrame) -> DataFrame:
    """The balance rows of price-register tenders."""
    return matching(balance, price_register_tenders, {"tender": "tender"}, unique=True).select(
        "year", "line", "code", F.col("quantity").alias("delivered"), "tender", F.col("value").alias("delivered_value")
    )
