"""Asset dimensions, register and ledger."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.changes import merge_matched, set_where
from ledgerlift.operators.numbering import continue_numbers, number_all
from ledgerlift.operators.picks import first_per_key, matching, summed, unmatched
from ledgerlift.params import RunParams


def _company(params: RunParams):
    return F.lit(params.company).cast("bigint").alias("company")


# ---- dimensions --------------------------------------------------------------------


def movement_kinds(spark) -> DataFrame:
    kinds = spark.createDataFrame(K.MOVEMENT_KINDS, K.MOVEMENT_KIND_SCHEMA)
    return kinds.withColumn("description", X.clean(F.col("description")))


def adjustment_kinds(spark, params: RunParams) -> DataFrame:
    rows = spark.createDataFrame([K.ADJUSTMENT_KIND], "code bigint, description string")
    return rows.select("code", _company(params), X.clean(F.col("description")).alias("description"))


def asset_groups(spark, params: RunParams) -> DataFrame:
    rows = spark.createDataFrame([K.ASSET_GROUP], "code bigint, description string")
    return rows.select("code", _company(params), "description")


def writeoff_reasons(asset: DataFrame, params: RunParams) -> DataFrame:
    """Write-off modes in use, as sale or plain write-off."""
    label = F.when(F.coalesce("writeoff_value", F.lit(0.0)) != 0, K.DISPOSAL_SALE).otherwise(K.WRITE_OFF)
    rows = asset.filter(F.col("writeoff_reason").isNotNull())
    return rows.select(F.col("writeoff_mode").alias("code"), _company(params), label.alias("description")).distinct()


def conditions(asset_condition: DataFrame, params: RunParams) -> DataFrame:
    return asset_condition.select(F.col("number").alias("code"), _company(params), F.col("name").alias("description"))


def asset_kinds(asset_kind: DataFrame, params: RunParams) -> DataFrame:
    return asset_kind.select(F.col("number").alias("code"), _company(params), F.col("name").alias("description"))


def departments(org_unit: DataFrame, params: RunParams) -> DataFrame:
    """Top-level units."""
    return org_unit.filter(F.col("parent").isNull()).select(
        _company(params), F.col("number").alias("code"), X.clean(F.col("name"), K.UNIT_NAME_WIDTH).alias("name"),
        V.hidden_flag(F.col("active")).alias("hidden"),
    )


def sectors(org_unit: DataFrame, asset_placement: DataFrame, params: RunParams) -> DataFrame:
    """Lower units that hold or held assets."""
    lower = matching(org_unit.filter(F.col("parent").isNotNull()), asset_placement, {"number": "unit"})
    return lower.select(
        F.col("number").alias("code"), _company(params), F.col("parent").alias("department"),
        X.clean(F.col("name"), K.UNIT_NAME_WIDTH).alias("name"), V.hidden_flag(F.col("active")).alias("hidden"),
    )


# ---- register ------------------------------------------------------------------------


def assets(
    asset: DataFrame, asset_placement: DataFrame, asset_valuation: DataFrame, asset_kind: DataFrame, params: RunParams
) -> DataFrame:
    """One row per asset with its first and current place and its residual value.

    An asset without placement stays; one that was only ever transferred goes.
    The latest valuation of each slot counts, the revalued slot first.
    """
    # One pass over the placements: first acquired place, current place, and whether it was ever acquired.
    acquired = F.coalesce("movement", F.lit("A")) == "A"
    places = asset_placement.groupBy(F.col("asset").alias("number")).agg(
        F.min_by("unit", F.when(acquired, F.col("sequence"))).alias("first_unit"),
        F.max_by("unit", "sequence").alias("current_unit"),
        F.max(acquired).alias("acquired_once"),
    )
    slot = F.coalesce("revalued", F.lit("N"))
    latest = first_per_key(
        asset_valuation.filter(slot.isin("N", "S")).withColumn("slot", slot),
        ["asset", "slot"],
        [F.col("valued").desc_nulls_first(), F.col("base_value").desc_nulls_last(), F.col("residual").desc_nulls_last()],
    )
    residual = latest.groupBy("asset").agg(
        F.max(F.when(F.col("slot") == "S", F.col("residual"))).alias("revalued"),
        F.max(F.when(F.col("slot") == "N", F.col("residual"))).alias("original"),
    )
    accounts = asset_kind.select(F.col("number").alias("asset_kind"), "account")
    placed = (
        asset.join(places, "number", "left")
        .filter(F.coalesce("acquired_once", F.lit(True)))
        .join(residual.withColumnRenamed("asset", "number"), "number", "left")
        .join(accounts, "asset_kind", "left")
    )
    # Only the key is numbered and goes through scratch.
    numbered = placed.join(number_all(placed.select("number"), [F.col("number").asc()], "n"), "number")
    return numbered.select(
        F.col("number").alias("asset"),
        _company(params),
        F.lit("001").alias("asset_group"),
        X.pad_grow(F.col("n"), 6).alias("plate"),
        "account",
        F.col("first_unit").alias("unit"),
        "current_unit",
        F.lit("C").alias("origin"),
        "asset_kind",
        "condition",
        X.clean(F.col("name")).alias("description"),
        "notes",
        "acquired",
        F.col("entered").alias("launched"),
        "acquisition_value",
        F.lit(0.0).alias("current_value"),
        "supplier",
        F.col("acquisition_doc").alias("invoice"),
        F.lit(None).cast("double").alias("quantity_share"),
        F.lit("V").alias("depreciation_basis"),
        F.coalesce("revalued", "original").alias("residual"),
        F.lit("M").alias("depreciation_cycle"),
        "commitment",
        F.year("committed").cast("bigint").alias("commitment_year"),
        "closed",
        X.join_loose(X.digits(F.col("number")), F.col("asset_plate")).alias("sync_key"),
        X.parse_number(F.col("writeoff_mode")).alias("writeoff_code"),
        F.col("asset_plate").alias("former_plate"),
        F.lit(None).cast("date").alias("accounted"),
    )


def unreadable_writeoffs(asset: DataFrame) -> DataFrame:
    """Reject frame: assets whose write-off mode is no number."""
    unread = F.col("writeoff_mode").isNotNull() & X.parse_number(F.col("writeoff_mode")).isNull()
    return asset.filter(unread).select(F.col("number").alias("asset"), "writeoff_mode")


# ---- ledger ------------------------------------------------------------------------------


def ledger(asset_placement: DataFrame, asset_valuation: DataFrame, depreciation: DataFrame, params: RunParams) -> DataFrame:
    """Acquisitions and transfers, depreciation and revaluations in date order.

    See :func:`ledger_rows`; numbered by date.
    """
    rows = ledger_rows(asset_placement, asset_valuation, depreciation)
    order = ("dated", "asset", "kind", "history", "value", "unit", "depreciation")
    return number_all(rows, [F.col(c).asc_nulls_last() for c in order], "movement").select(
        "movement", _company(params), *rows.columns, F.col("dated").alias("accounted"), F.col("movement").alias("sync_key")
    )


def ledger_rows(asset_placement: DataFrame, asset_valuation: DataFrame, depreciation: DataFrame) -> DataFrame:
    """Movements without numbers.

    An acquisition has the original value of its asset: that of the earliest original valuation, of
    several on that day the highest.  A transfer has no value; depreciation is negative.
    """
    # The earliest day first, NULL before all others, and of a day the highest value.
    rank = F.struct(F.col("valued").isNotNull(), "valued", F.col("base_value").isNull(), -F.col("base_value"))
    originals = summed(
        asset_valuation.filter("revalued = 'N'"), ["asset"], F.min_by(F.struct("base_value"), rank).alias("first")
    ).select("asset", "first.base_value")
    moved = F.col("movement") == "T"
    placements = asset_placement.join(originals, "asset").select(
        "asset", F.col("started").alias("dated"), F.col("movement").alias("kind"),
        F.when(moved, F.lit(0.0)).otherwise(F.col("base_value")).alias("value"), "unit",
        F.when(moved, K.TRANSFER).otherwise(K.ACQUISITION).alias("history"), F.lit("N").alias("depreciation"),
    )
    no_unit = F.lit(None).cast("bigint").alias("unit")
    worn = depreciation.select(
        "asset", F.col("valued").alias("dated"), F.lit("R").alias("kind"), (-F.col("value")).alias("value"), no_unit,
        X.join_loose(F.lit(K.DEPRECIATION), X.digits(F.col("month")), F.lit("-"), X.digits(F.col("year"))).alias("history"),
        F.lit("S").alias("depreciation"),
    )
    revalued = (
        asset_valuation.groupBy("asset")
        .agg(
            F.max("valued").alias("dated"), (F.max("base_value") - F.min("base_value")).alias("value"),
            F.count("*").alias("n"),
        )
        .filter("n > 1")
        .select(
            "asset", "dated", F.lit("R").alias("kind"), "value", no_unit, F.lit(K.REVALUATION).alias("history"),
            F.lit("N").alias("depreciation"),
        )
    )
    return placements.unionByName(worn).unionByName(revalued)


def unvalued_placements(asset_placement: DataFrame, asset_valuation: DataFrame) -> DataFrame:
    """Reject frame: placements of assets without an original valuation, which the ledger lacks."""
    return unmatched(asset_placement, asset_valuation.filter("revalued = 'N'"), {"asset": "asset"})


def balances(register: DataFrame, movements: DataFrame) -> DataFrame:
    """Register with revaluation dates, accounting dates and the balance of the ledger."""
    keys = {"asset": "asset"}
    last = summed(movements.filter("kind = 'R' AND depreciation <> 'S'"), ["asset"], F.max("dated").alias("last_date"))
    dated = merge_matched(register, last, keys, {"launched": "last_date", "accounted": "last_date"}, unique=True)
    fallback = F.when(F.col("closed").isNull(), F.col("launched")).otherwise(F.col("closed"))
    dated = set_where(dated, F.col("accounted").isNull(), {"accounted": fallback})
    total = summed(movements, ["asset"], V.exact_sum(F.col("value")).alias("total"))
    return merge_matched(dated, total, keys, {"current_value": "total"}, unique=True)


def writeoffs(register: DataFrame, movements: DataFrame) -> DataFrame:
    """Closing row of every closed asset, at its balance, numbered after the ledger.

    The row repeats the balance with a positive sign.
    """
    closed = register.filter(F.col("closed").isNotNull())
    return continue_numbers(movements.select("movement"), "movement", closed, [F.col("asset").asc()]).select(
        "movement", "company", "asset", F.col("closed").alias("dated"), F.lit("B").alias("kind"),
        F.col("current_value").alias("value"), F.col("current_unit").alias("unit"), F.lit(K.WRITE_OFF).alias("history"),
        F.lit("N").alias("depreciation"), F.col("closed").alias("accounted"), F.lit(None).cast("bigint").alias("sync_key"),
    )
