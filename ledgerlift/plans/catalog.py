"""Units of measure, catalog groups, subgroups and items, stores and cost centres."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators.lookups import lookup, misses
from ledgerlift.operators.numbering import anew, blocked, highest
from ledgerlift.operators.picks import any_one, first_per_key
from ledgerlift.params import RunParams
from ledgerlift.session import written


def units(unit_of_measure: DataFrame) -> DataFrame:
    """One name per unit code: the alphabetically first."""
    first = first_per_key(unit_of_measure, ["code"], [F.col("name").asc_nulls_last()])
    return first.select(X.clean(F.col("code")).alias("code"), X.clean(F.col("name")).alias("name"))


def groups(catalog_group: DataFrame, service_group: DataFrame, numbers=anew) -> DataFrame:
    """Top-level groups and the service family under running codes, in (kind, number) order.

    ``numbers`` gives them, anew or from a register.
    """
    top = catalog_group.filter("level = 0").select("kind", "number", "name")
    services = service_group.select(F.lit(K.SERVICE_FAMILY).alias("kind"), "number", "name")
    order = [F.col("kind").asc(), F.col("number").asc()]
    numbered = numbers("groups", top.unionByName(services), ["kind", "number"], order)
    return numbered.select(
        X.pad_grow(F.col("n"), 3).alias("group_code"),
        X.clean(F.col("name")).alias("name"),
        F.lit("N").alias("hidden"),
        F.lit(None).cast("string").alias("counter_entry"),
        F.lit(None).cast("string").alias("counter_exit"),
        "kind",
        "number",
    )


def subgroups(catalog_group: DataFrame, service_group: DataFrame, coded_groups: DataFrame) -> DataFrame:
    """Lower-level groups under their group; each service group gets subgroup ``001``.

    The subgroup is the number without its first digit, however long it is.  A parent without a group
    code stops the run.
    """
    parents = catalog_group.select(F.col("kind").alias("parent_kind"), F.col("number").alias("parent_number"))
    lower = (
        catalog_group.filter("level > 0")
        .join(parents, ["parent_kind", "parent_number"])
        .select(
            "parent_kind", "parent_number", "kind", "number", "name",
            X.after_first(F.col("number")).alias("subgroup"),
        )
        .distinct()
    )
    family = F.lit(K.SERVICE_FAMILY)
    services = service_group.select(
        family.alias("parent_kind"), F.col("number").alias("parent_number"), family.alias("kind"), "number", "name",
        F.lit("001").alias("subgroup"),
    )
    keyed = lookup(
        lower.unionByName(services), coded_groups, {"parent_kind": "kind", "parent_number": "number"}, ["group_code"], "fail"
    )
    return keyed.select(
        "group_code", "subgroup", X.clean(F.col("name")).alias("name"), F.lit("N").alias("hidden"), "kind", "number",
        F.lit("S").alias("base"),
    )


def orphan_groups(catalog_group: DataFrame) -> DataFrame:
    """Reject frame: lower-level groups whose parent is no group."""
    lower = catalog_group.filter("level > 0").select("parent_kind", "parent_number", "kind", "number", "name").distinct()
    return misses(lower, catalog_group.select("kind", "number"), {"parent_kind": "kind", "parent_number": "number"})


def ungrouped_goods(catalog_item: DataFrame, catalog_group: DataFrame) -> DataFrame:
    """Reject frame: goods of an unknown group, which get no code."""
    return misses(catalog_item, catalog_group.select("kind", "number"), {"group_kind": "kind", "group_number": "number"})


def _item_kind(kind, number):
    expression = F
    for group_number, group_kind, item_kind in K.ITEM_KINDS:
        expression = expression.when((number == group_number) & (kind == group_kind), item_kind)
    return expression.otherwise("P")


def items(
    catalog_item: DataFrame,
    catalog_group: DataFrame,
    service_item: DataFrame,
    base_subgroups: DataFrame,
    params: RunParams,
    numbers=anew,
) -> dict[str, DataFrame]:
    """Coded items of both families and the subgroups opened for full ones.

    Items are numbered in their subgroup.  Past ``params.block_size`` a new
    subgroup is opened, numbered on from the highest subgroup in use.
    ``numbers`` gives the numbers, anew or from a register.
    """
    parents = catalog_group.select(
        F.col("kind").alias("group_kind"), F.col("number").alias("group_number"), "parent_kind", "parent_number"
    )
    goods = catalog_item.join(parents, ["group_kind", "group_number"]).select(
        F.col("number").alias("material"),
        F.col("group_kind").alias("kind"),
        F.col("group_number").alias("number"),
        "name",
        F.col("min_stock").cast("double").alias("min_stock"),
        F.col("max_stock").cast("double").alias("max_stock"),
        V.hidden_flag(F.col("active")).alias("hidden"),
        F.col("unit_code"),
        _item_kind(F.col("parent_kind"), F.col("parent_number")).alias("item_kind"),
        F.when(F.col("parent_kind") == "2", "P").otherwise("C").alias("item_use"),
    )
    services = service_item.select(
        F.col("number").alias("material"),
        F.lit(K.SERVICE_FAMILY).alias("kind"),
        F.col("group_number").alias("number"),
        "name",
        F.lit(0.0).alias("min_stock"),
        F.lit(0.0).alias("max_stock"),
        F.lit("N").alias("hidden"),
        "unit_code",
        F.lit("P").alias("item_kind"),
        F.lit("C").alias("item_use"),
    )
    keys = ["kind", "number"]
    both = goods.unionByName(services)
    # Only keys are numbered and go through scratch; used for new subgroups and for codes.
    in_group = numbers("items", both.select(*keys, "material"), [*keys, "material"], [F.col("material").asc()], within=keys)
    placing = written(blocked(in_group, "n", params.block_size), "item-codes")
    coded = both.join(placing, [*keys, "material"])
    top = highest(base_subgroups.select(F.col("subgroup").cast("bigint").alias("subgroup")), "subgroup")
    full = placing.filter("block > 0").select(*keys, "block").distinct()
    opened = numbers("opened_subgroups", full, [*keys, "block"], [F.col(c) for c in (*keys, "block")], start=top)
    opened = opened.withColumnRenamed("n", "opened")
    placed = lookup(coded, base_subgroups, {k: k for k in keys}, ["group_code", "subgroup"], "fail")
    placed = placed.join(opened, [*keys, "block"], "left").withColumn(
        "subgroup", F.coalesce(X.pad_grow(F.col("opened"), 3), F.col("subgroup"))
    )
    serial = X.pad_grow(F.col("serial"), 3)
    new_rows = opened.join(base_subgroups.drop("subgroup", "base"), keys)
    return {
        "items": placed.select(
            "group_code", "subgroup", serial.alias("serial"),
            X.item_code(F.col("group_code"), F.col("subgroup"), serial).alias("code"),
            F.when(F.col("kind") == K.SERVICE_FAMILY, F.lit(K.SERVICE_FAMILY)).otherwise("1").alias("family"),
            "material", X.clean(F.col("name")).alias("name"), "min_stock", "max_stock", "hidden",
            X.clean(F.col("unit_code")).alias("unit_code"), "item_kind", "item_use",
        ),
        "opened_subgroups": new_rows.select(
            "group_code", X.pad_grow(F.col("opened"), 3).alias("subgroup"), "name", F.lit("N").alias("hidden"),
            "kind", "number", F.lit("N").alias("base"),
        ),
    }


def destinations(store: DataFrame, params: RunParams) -> DataFrame:
    return store.select(
        X.pad_grow(F.col("number"), 9).alias("code"),
        X.clean(F.col("name")).alias("name"),
        F.lit(params.company).cast("bigint").alias("company"),
    )


def cost_centres(org_unit: DataFrame, stock_request: DataFrame, authority: DataFrame, params: RunParams) -> DataFrame:
    """A default centre and one per organisational unit.

    Each unit is served by one of the stores it has drawn from (the lowest), or
    by the default store.
    """
    company = F.lit(params.company).cast("bigint")
    head = authority.filter(F.col("company") == params.company).orderBy("authority", "body").limit(1)
    first = head.first()
    authority_code, body = (first["authority"], first["body"]) if first else (None, None)
    store = any_one(stock_request, "unit", "store")
    served = lookup(org_unit, store, {"number": "unit"}, ["store"], "null")
    centres = served.select(
        F.col("number").cast("bigint").alias("centre"),
        X.clean(F.col("name"), K.UNIT_NAME_WIDTH).alias("name"),
        F.lit(K.DEFAULT_CENTRE).alias("sub_centre"),
        V.hidden_flag(F.col("active")).alias("hidden"),
        company.alias("company"),
        F.lit(authority_code).cast("string").alias("authority"),
        F.lit(body).cast("string").alias("body"),
        F.coalesce(X.pad_grow(F.col("store"), 9), F.lit(K.DEFAULT_STORE)).alias("store"),
    )
    sentinel = head.select(
        F.lit(0).cast("bigint").alias("centre"),
        F.lit(None).cast("string").alias("name"),
        F.lit(K.DEFAULT_CENTRE).alias("sub_centre"),
        F.lit(None).cast("string").alias("hidden"),
        company.alias("company"),
        "authority",
        "body",
        F.lit(K.DEFAULT_STORE).alias("store"),
    )
    return centres.unionByName(sentinel)
