"""The given tables in the role of the source entities, in Spark and in SQL.

Orders play quotes, tenders, purchase orders and stock documents; line items
play their lines, offers and bids; parts are catalog items and vehicles;
suppliers are bidders, stores and units; customers are drivers and assets.
"""

from functools import cached_property

from pyspark.sql import functions as F

from checks.registry import Tables
from ledgerlift.params import RunParams
from ledgerlift.session import shuffle_partitions

PARAMS = RunParams(company=1, fiscal_year=1998, block_size=10)
FLEET_PARAMS = RunParams(company=1, fiscal_year=2024)


def _type_index(column):
    first = F.ascii(column) - 64
    return (first * 10 + F.length(column)).cast("bigint")


def _brand_number():
    return F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("bigint")


def _unit_price():
    return F.col("l_extendedprice") / F.col("l_quantity")


def _year(column):
    return F.year(column).cast("bigint")


def _null(kind):
    return F.lit(None).cast(kind)


class Entities:
    """Source entities by name; the text ``ENTITIES`` defines the same frames in SQL."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def unit_of_measure(self):
        return self.t.part.select(F.col("p_brand").alias("code"), F.col("p_name").alias("name"))

    @cached_property
    def _branded(self):
        no = _brand_number()
        return self.t.part.select(
            "*",
            (F.floor(no / 9) + 1).cast("string").alias("kind"),
            ((no % 9 + 1) * 1000).alias("group_no"),
            ((no % 9 + 1) * 1000 + _type_index("p_type")).alias("sub_no"),
        )

    @cached_property
    def catalog_group(self):
        top = self._branded.select(
            "kind", F.col("group_no").alias("number"), F.col("p_brand").alias("name"), F.lit(0).alias("level"),
            _null("string").alias("parent_kind"), _null("bigint").alias("parent_number"),
        ).distinct()
        lower = self._branded.select(
            "kind", F.col("sub_no").alias("number"), F.concat("p_brand", F.lit(" "), "p_type").alias("name"),
            F.lit(1).alias("level"), F.col("kind").alias("parent_kind"), F.col("group_no").alias("parent_number"),
        ).distinct()
        return top.unionByName(lower)

    @cached_property
    def catalog_item(self):
        return self._branded.select(
            F.col("p_partkey").alias("number"), F.col("p_name").alias("name"), F.col("kind").alias("group_kind"),
            F.col("sub_no").alias("group_number"), F.col("p_size").cast("double").alias("min_stock"),
            F.col("p_retailprice").alias("max_stock"),
            F.when(F.col("p_size") <= 40, "S").when(F.col("p_size") <= 45, "N").alias("active"),
            F.col("p_brand").alias("unit_code"),
        )

    @cached_property
    def service_group(self):
        return self.t.nation.select(F.col("n_nationkey").cast("bigint").alias("number"), F.col("n_name").alias("name"))

    @cached_property
    def service_item(self):
        return self.t.supplier.select(
            F.col("s_suppkey").alias("number"), F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("bigint").alias("group_number"), _null("string").alias("unit_code"),
        )

    @cached_property
    def item_codes(self):
        """Coded goods for the plans that look up a material."""
        return self.t.part.select(
            F.lit("1").alias("family"), F.col("p_partkey").alias("material"),
            F.concat(F.lit("001."), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("code"),
        )

    @cached_property
    def store(self):
        return self.t.supplier.select(F.col("s_suppkey").alias("number"), F.col("s_name").alias("name"))

    @cached_property
    def person(self):
        return self.t.supplier.select(F.col("s_suppkey").alias("number"), F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("name"))

    @cached_property
    def org_unit(self):
        top = self.t.nation.select(
            F.col("n_nationkey").cast("bigint").alias("number"), F.col("n_name").alias("name"),
            F.when(F.col("n_regionkey") < 3, "S").otherwise("N").alias("active"), _null("bigint").alias("parent"),
        )
        lower = self.t.supplier.select(
            (F.col("s_suppkey") + 100).alias("number"), F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") >= 5000, "S").alias("active"), F.col("s_nationkey").cast("bigint").alias("parent"),
        )
        return top.unionByName(lower)

    @cached_property
    def authority(self):
        return self.t.nation.select(
            F.lit(1).cast("bigint").alias("company"),
            F.lpad((F.col("n_nationkey") + 3).cast("string"), 2, "0").alias("authority"),
            F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("body"),
        )

    @cached_property
    def quote(self):
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), _year("o_orderdate").alias("year"), F.col("o_custkey").alias("doc_number"),
            F.to_date("o_orderdate").alias("issued"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("tender"),
            F.col("o_orderpriority").alias("subject"),
        )

    @cached_property
    def quote_line(self):
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("quote"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("material"), F.col("l_suppkey").alias("bidder"), F.col("l_quantity").alias("quantity"),
            _unit_price().alias("price"), F.nullif(F.col("l_linestatus"), F.lit("F")).alias("brand"),
            (F.col("l_returnflag") == "A").cast("int").alias("lowest"),
        )

    @cached_property
    def stock_request(self):
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), _year("o_orderdate").alias("year"), F.to_date("o_orderdate").alias("issued"),
            F.col("o_custkey").alias("store"), (F.col("o_custkey") + 100).alias("unit"),
            F.when(F.col("o_orderstatus") == "F", "S").when(F.col("o_orderstatus") == "O", "N").alias("direct"),
        )

    @cached_property
    def tender(self):
        day = F.to_date("o_orderdate")
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), _year("o_orderdate").alias("year"), F.col("o_custkey").alias("process_number"),
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("doc_number"),
            F.concat("o_orderpriority", F.lit(" €日")).alias("subject"),
            F.when(F.col("o_orderstatus") == "O", "S").otherwise("N").alias("price_register"),
            day.alias("dated"), day.alias("opened"), F.lit("08:30").alias("open_time"), F.lit("09:45").alias("delivery_time"),
            F.when(F.col("o_orderstatus") != "P", day).alias("approved"), F.col("o_orderpriority").alias("office"),
            _null("string").alias("external_code"),
            (F.substring("o_orderpriority", 1, 1).cast("int") * 4).alias("modality"),
            day.alias("published"), F.date_add(day, 30).alias("closed"), F.lit("17:00").alias("close_time"),
            F.col("o_totalprice").alias("amount"),
        )

    @cached_property
    def modality_names(self):
        """The target's own names; code 99 is used by no tender."""
        code = F.when(F.substring("o_orderpriority", 1, 1) == "1", 4).otherwise(99).cast("bigint")
        return self.t.orders.groupBy(code.alias("code")).agg(F.max("o_orderpriority").alias("name"))

    @cached_property
    def held_sessions(self):
        return self.t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("tender"))

    @cached_property
    def tender_bidder(self):
        return self.t.lineitem.groupBy(F.col("l_orderkey").alias("tender"), F.col("l_suppkey").alias("bidder")).agg(
            F.max("l_linestatus").alias("representative"), F.max("l_returnflag").alias("tax_id")
        )

    @cached_property
    def tender_offer(self):
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("tender"), F.col("l_partkey").alias("material"), F.col("l_suppkey").alias("bidder"),
            F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_quantity").alias("quantity"),
            _unit_price().alias("unit_price"), F.col("l_extendedprice").alias("total"),
            (F.col("l_returnflag") == "A").cast("int").alias("lowest"), F.to_date("l_shipdate").alias("offer"),
        )

    @cached_property
    def placed_offer(self):
        """Offers placed by their tender.  Quantity and total go through the shuffle, not the price that follows from them."""
        placed = self.tender_offer.drop("unit_price").repartition("tender")
        return placed.withColumn("unit_price", F.col("total") / F.col("quantity")).select(*self.tender_offer.columns)

    @cached_property
    def _ordered_lines(self):
        """Lines placed by their order: whatever is grouped by order and more needs no further shuffle."""
        return self.t.lineitem.repartition("l_orderkey")

    @cached_property
    def tender_item(self):
        # Flags go through the shuffle, not the values they follow from.  Its partitions are not put together by their size:
        # such rows pack so well that a task would group several times as many of them as of others.
        flagged = self.t.lineitem.select(
            "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_discount") > 0.09).alias("annex"), (F.col("l_returnflag") == "R").alias("failed")
        ).repartition(shuffle_partitions(self.t.spark), "l_orderkey")
        return flagged.groupBy(F.col("l_orderkey").alias("tender"), F.col("l_partkey").alias("material")).agg(
            F.min("l_linenumber").cast("bigint").alias("line"),
            F.when(F.max("annex"), "S").otherwise("N").alias("annex"),
            F.when(F.max("failed"), "S").alias("failed"),
        )

    @cached_property
    def tender_item_avg(self):
        total = F.sum(F.col("l_extendedprice").cast("decimal(28,8)")).cast("double")
        return self._ordered_lines.groupBy(F.col("l_orderkey").alias("tender"), F.col("l_partkey").alias("material")).agg(
            (total / F.sum("l_quantity")).alias("avg_price"), total.alias("total")
        )

    @cached_property
    def bid_round(self):
        return self.t.lineitem.filter("l_linestatus = 'O'").select(
            F.col("l_orderkey").alias("tender"), F.col("l_suppkey").alias("bidder"), F.col("l_partkey").alias("material"),
            F.month("l_shipdate").cast("bigint").alias("round"), _unit_price().alias("price"),
            F.when(F.col("l_returnflag") == "A", "S").otherwise("N").alias("winner"),
        )

    @cached_property
    def lotted(self):
        """Tenders whose lot is already loaded."""
        return self.t.orders.filter("o_orderstatus = 'F'").select(
            F.col("o_orderkey").alias("tender"), F.lit("00000001").alias("lot")
        )

    @cached_property
    def settled(self):
        """Lines and bidders already loaded."""
        return self.t.lineitem.filter("l_tax = 0.08").select(
            F.col("l_orderkey").alias("tender"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_suppkey").alias("bidder"),
        )

    @cached_property
    def request(self):
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), F.when(F.col("o_orderstatus") == "O", 2).otherwise(1).alias("type")
        )

    @cached_property
    def request_line(self):
        return self.t.lineitem.filter("l_returnflag = 'A'").select(
            F.col("l_orderkey").alias("request"), F.col("l_partkey").alias("material"), F.col("l_quantity").alias("quantity")
        )

    @cached_property
    def request_tender(self):
        return self.t.orders.select(F.col("o_orderkey").alias("request"), F.col("o_orderkey").alias("tender"))

    @cached_property
    def price_adjustment(self):
        return self.t.lineitem.filter("l_returnflag <> 'R'").select(
            F.col("l_orderkey").alias("tender"), F.col("l_partkey").alias("material"), _unit_price().alias("unit_price"),
            F.to_date("l_shipdate").alias("starts"),
        )

    @cached_property
    def purchase_order(self):
        month = F.month("o_orderdate").cast("bigint")
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), _year("o_orderdate").alias("year"), F.col("o_custkey").alias("doc_number"),
            F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("sub_number"), F.col("o_custkey").alias("commitment"),
            F.to_date("o_orderdate").alias("issued"), F.col("o_custkey").alias("supplier"),
            F.col("o_orderpriority").alias("payment_terms"), _null("string").alias("notes"), _null("string").alias("delivery_place"),
            month.alias("budget_line"), month.alias("expense_category"), month.alias("expense_group"),
            month.alias("expense_modality"), month.alias("expense_element"), _null("bigint").alias("expense_detail"),
            _null("bigint").alias("link_group"), month.alias("link_code"),
            F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("tender"), (F.col("o_custkey") + 100).alias("unit"),
            F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") - 1).alias("parent"), F.col("o_custkey").alias("store"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("contract_number"),
            _year("o_orderdate").alias("contract_year"),
        )

    @cached_property
    def order_line(self):
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("material"), F.col("l_quantity").alias("quantity"), _unit_price().alias("unit_price"),
            F.col("l_extendedprice").alias("total"),
        )

    @cached_property
    def order_annulment(self):
        return self.t.lineitem.filter("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("value"),
        )

    @cached_property
    def register_tenders(self):
        return self.t.orders.filter("o_orderstatus = 'O' AND o_totalprice > 200000").select(F.col("o_orderkey").alias("tender"))

    @cached_property
    def commitment(self):
        return self.t.customer.select(
            F.col("c_custkey").alias("number"), F.col("c_acctbal").alias("amount"),
            F.when(F.col("c_mktsegment") == "BUILDING", 1997).alias("carried_year"),
        )

    @cached_property
    def loaded_items(self):
        return self.t.lineitem.filter("l_linestatus = 'O'").select(
            F.col("l_orderkey").alias("tender"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.concat(F.lit("001."), F.lpad(F.col("l_partkey").cast("string"), 6, "0")).alias("code"),
        )

    @cached_property
    def holder(self):
        return self.t.customer.select(F.col("c_custkey").alias("number"), F.col("c_name").alias("name"))

    @cached_property
    def driver(self):
        return self.t.customer.select(
            F.col("c_custkey").alias("person"), F.col("c_name").alias("licence"), F.col("c_mktsegment").alias("licence_class"),
            _null("date").alias("licence_expires"),
        )

    @cached_property
    def vehicle_type(self):
        return self.t.part.select(_type_index("p_type").alias("number"), F.col("p_type").alias("name")).distinct()

    @cached_property
    def vehicle(self):
        words = F.split("p_name", " ")
        return self.t.part.select(
            F.col("p_partkey").alias("number"), words.getItem(0).alias("plate_letters"), words.getItem(1).alias("plate_digits"),
            F.col("p_name").alias("name"), _null("string").alias("chassis"), F.col("p_type").alias("colour"),
            F.col("p_size").cast("bigint").alias("built"),
            F.nullif(F.col("p_size"), F.lit(50)).cast("bigint").alias("model_year"), _null("string").alias("registration"),
            F.date_add(F.lit("1995-01-01").cast("date"), F.floor("p_retailprice").cast("int")).alias("acquired"),
            _null("bigint").alias("driver"), _brand_number().alias("make"), _type_index("p_type").alias("vehicle_type"),
            F.col("p_size").cast("bigint").alias("fuel_type"), F.col("p_retailprice").alias("km"),
            _null("string").alias("notes"), _null("date").alias("sold"), _null("date").alias("licensed_until"),
            _null("double").alias("oil_change_km"),
        )

    @cached_property
    def fuel_type(self):
        return self.t.nation.select(F.col("n_nationkey").cast("bigint").alias("number"), F.col("n_name").alias("name"))

    @cached_property
    def centre(self):
        return self.org_unit.select(F.col("number").alias("centre"))

    @cached_property
    def _purchases(self):
        return self.t.events.filter("event_type = 'purchase'")

    @cached_property
    def fuel_request(self):
        return self._purchases.select(
            F.col("event_id").alias("number"), F.col("ts").alias("issued"), _null("bigint").alias("supplier"),
            F.col("user_id").alias("driver"), F.col("value").alias("km"), F.col("user_id").alias("vehicle"),
        )

    @cached_property
    def fuel_request_line(self):
        def line(n):
            return self._purchases.select(
                F.col("event_id").alias("request"), F.lit(n).cast("bigint").alias("line"), F.col("user_id").alias("material"),
                (F.col("value") * n).alias("quantity"), (F.col("value") / 2).alias("unit_price"), F.col("value").alias("total"),
            )

        return line(1).unionByName(line(2))

    @cached_property
    def inventory(self):
        total = F.sum(F.col("l_extendedprice").cast("decimal(28,8)")).cast("double")
        return self._ordered_lines.groupBy(
            _year("l_shipdate").alias("year"), F.month("l_shipdate").cast("bigint").alias("month"),
            F.col("l_suppkey").alias("store"), F.col("l_partkey").alias("material"),
        ).agg(F.sum("l_quantity").alias("balance"), (total / F.sum("l_quantity")).alias("price"))

    @cached_property
    def known_codes(self):
        """Item codes with some materials missing."""
        return self.item_codes.join(
            self.t.part.filter("p_size <= 45").select(F.col("p_partkey").alias("material")), "material"
        )

    @cached_property
    def movement(self):
        return self.t.orders.select(
            F.col("o_orderkey").alias("number"), _year("o_orderdate").alias("year"), F.to_date("o_orderdate").alias("issued"),
            F.col("o_custkey").alias("store"), F.col("o_custkey").alias("supplier"),
        )

    @cached_property
    def movement_line(self):
        direct = F.when(F.col("l_returnflag") == "N", "S").when(F.col("l_linestatus") == "O", "N")
        return self.t.lineitem.filter("l_returnflag <> 'R'").select(
            F.col("l_orderkey").alias("movement"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("material"), F.col("l_quantity").alias("quantity"), _unit_price().alias("unit_price"),
            F.col("l_extendedprice").alias("total"), direct.alias("direct"),
        )

    @cached_property
    def stock_request_line(self):
        return self.t.lineitem.filter("l_returnflag = 'R'").select(
            F.col("l_orderkey").alias("request"), F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("material"), F.col("l_quantity").alias("quantity"),
        )

    @cached_property
    def asset(self):
        last = self.t.orders.groupBy(F.col("o_custkey").alias("number")).agg(F.to_date(F.max("o_orderdate")).alias("last_day"))
        closed = F.col("c_acctbal") < 0
        entered = F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey"))
        return self.t.customer.withColumnRenamed("c_custkey", "number").join(last, "number", "left").select(
            "number", F.col("c_name").alias("asset_plate"), F.col("c_mktsegment").alias("name"), _null("string").alias("notes"),
            _type_index("c_mktsegment").alias("asset_kind"), F.col("c_nationkey").cast("bigint").alias("condition"),
            _null("date").alias("acquired"), entered.alias("entered"), F.col("c_acctbal").alias("acquisition_value"),
            _null("bigint").alias("supplier"), F.col("c_name").alias("acquisition_doc"), _null("string").alias("commitment"),
            entered.alias("committed"), F.when(closed, F.col("last_day")).alias("closed"),
            F.when(closed, F.col("c_nationkey").cast("string")).alias("writeoff_mode"),
            F.when(closed, "X").alias("writeoff_reason"),
            F.when(F.col("c_acctbal") < -500, F.col("c_acctbal")).alias("writeoff_value"),
        )

    @cached_property
    def asset_kind(self):
        number = _type_index("c_mktsegment")
        return self.t.customer.select(
            number.alias("number"), F.col("c_mktsegment").alias("name"), F.concat(F.lit("A"), number.cast("string")).alias("account")
        ).distinct()

    @cached_property
    def asset_condition(self):
        return self.t.supplier.select(F.col("s_suppkey").alias("number"), F.col("s_name").alias("name"))

    @cached_property
    def asset_placement(self):
        unit = 100 + F.substring("o_orderpriority", 1, 1).cast("bigint") * 10 + F.month("o_orderdate")
        return self.t.orders.select(
            F.col("o_custkey").alias("asset"), F.col("o_orderkey").alias("sequence"), unit.alias("unit"),
            F.to_date("o_orderdate").alias("started"),
            F.when(F.col("o_orderstatus") == "P", "A").when(F.col("o_orderpriority") != "5-LOW", "T").alias("movement"),
        )

    @cached_property
    def asset_valuation(self):
        return self.t.orders.filter("o_orderstatus <> 'P'").select(
            F.col("o_custkey").alias("asset"), F.to_date("o_orderdate").alias("valued"), F.col("o_totalprice").alias("base_value"),
            (F.col("o_totalprice") / 2).alias("residual"),
            F.when(F.col("o_orderstatus") == "O", "S").otherwise("N").alias("revalued"),
        )

    @cached_property
    def depreciation(self):
        return self.t.events.filter("event_type = 'error'").select(
            F.col("user_id").alias("asset"), F.to_date("ts").alias("valued"), "value",
            F.month("ts").cast("bigint").alias("month"), _year("ts").alias("year"),
        )


ENTITIES = """
branded AS (SELECT *, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS no,
    CAST(CAST(replace(p_brand, 'Brand#', '') AS BIGINT) // 9 + 1 AS VARCHAR) AS kind,
    (CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 9 + 1) * 1000 AS group_no,
    (CAST(replace(p_brand, 'Brand#', '') AS BIGINT) % 9 + 1) * 1000 + (ascii(p_type) - 64) * 10 + length(p_type) AS sub_no
    FROM part),
unit_of_measure AS (SELECT p_brand AS code, p_name AS name FROM part),
catalog_group AS (
    SELECT DISTINCT kind, group_no AS number, p_brand AS name, 0 AS level, CAST(NULL AS VARCHAR) AS parent_kind,
        CAST(NULL AS BIGINT) AS parent_number FROM branded
    UNION ALL SELECT DISTINCT kind, sub_no, p_brand || ' ' || p_type, 1, kind, group_no FROM branded),
catalog_item AS (SELECT p_partkey AS number, p_name AS name, kind AS group_kind, sub_no AS group_number,
    p_size AS min_stock, p_retailprice AS max_stock, CASE WHEN p_size <= 40 THEN 'S' WHEN p_size <= 45 THEN 'N' END AS active,
    p_brand AS unit_code FROM branded),
service_group AS (SELECT CAST(n_nationkey AS BIGINT) AS number, n_name AS name FROM nation),
service_item AS (SELECT s_suppkey AS number, s_name AS name, s_nationkey AS group_number, CAST(NULL AS VARCHAR) AS unit_code
    FROM supplier),
item_codes AS (SELECT '1' AS family, p_partkey AS material, '001.' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code FROM part),
store AS (SELECT s_suppkey AS number, s_name AS name FROM supplier),
person AS (SELECT s_suppkey AS number, '  ' || s_name || ' ' AS name FROM supplier),
org_unit AS (SELECT CAST(n_nationkey AS BIGINT) AS number, n_name AS name,
    CASE WHEN n_regionkey < 3 THEN 'S' ELSE 'N' END AS active, CAST(NULL AS BIGINT) AS parent FROM nation
    UNION ALL SELECT s_suppkey + 100, s_name, CASE WHEN s_acctbal >= 5000 THEN 'S' END, s_nationkey FROM supplier),
authority AS (SELECT 1 AS company, lpad(CAST(n_nationkey + 3 AS VARCHAR), 2, '0') AS authority,
    lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS body FROM nation),
quote AS (SELECT o_orderkey AS number, year(o_orderdate) AS year, o_custkey AS doc_number, CAST(o_orderdate AS DATE) AS issued,
    CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS tender, o_orderpriority AS subject FROM orders),
quote_line AS (SELECT l_orderkey AS quote, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS material, l_suppkey AS bidder,
    l_quantity AS quantity, l_extendedprice / l_quantity AS price, NULLIF(l_linestatus, 'F') AS brand,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS lowest FROM lineitem),
stock_request AS (SELECT o_orderkey AS number, year(o_orderdate) AS year, CAST(o_orderdate AS DATE) AS issued, o_custkey AS store,
    o_custkey + 100 AS unit, CASE WHEN o_orderstatus = 'F' THEN 'S' WHEN o_orderstatus = 'O' THEN 'N' END AS direct FROM orders),
tender AS (SELECT o_orderkey AS number, year(o_orderdate) AS year, o_custkey AS process_number, 'T' || o_orderkey AS doc_number,
    o_orderpriority || ' €日' AS subject, CASE WHEN o_orderstatus = 'O' THEN 'S' ELSE 'N' END AS price_register,
    CAST(o_orderdate AS DATE) AS dated, CAST(o_orderdate AS DATE) AS opened, '08:30' AS open_time, '09:45' AS delivery_time,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS approved, o_orderpriority AS office,
    CAST(NULL AS VARCHAR) AS external_code, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 4 AS modality,
    CAST(o_orderdate AS DATE) AS published, CAST(o_orderdate AS DATE) + 30 AS closed, '17:00' AS close_time,
    o_totalprice AS amount FROM orders),
modality_names AS (SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 4 ELSE 99 END AS code, MAX(o_orderpriority) AS name
    FROM orders GROUP BY 1),
held_sessions AS (SELECT o_orderkey AS tender FROM orders WHERE o_orderstatus = 'F'),
tender_bidder AS (SELECT l_orderkey AS tender, l_suppkey AS bidder, MAX(l_linestatus) AS representative, MAX(l_returnflag) AS tax_id
    FROM lineitem GROUP BY 1, 2),
tender_offer AS (SELECT l_orderkey AS tender, l_partkey AS material, l_suppkey AS bidder, CAST(l_linenumber AS BIGINT) AS line,
    l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total,
    CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS lowest, CAST(l_shipdate AS DATE) AS offer FROM lineitem),
tender_item AS (SELECT l_orderkey AS tender, l_partkey AS material, CAST(MIN(l_linenumber) AS BIGINT) AS line,
    CASE WHEN MAX(l_discount) > 0.09 THEN 'S' ELSE 'N' END AS annex, CASE WHEN MAX(l_returnflag) = 'R' THEN 'S' END AS failed
    FROM lineitem GROUP BY 1, 2),
tender_item_avg AS (SELECT l_orderkey AS tender, l_partkey AS material,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,8))) AS DOUBLE) / SUM(l_quantity) AS avg_price,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,8))) AS DOUBLE) AS total FROM lineitem GROUP BY 1, 2),
bid_round AS (SELECT l_orderkey AS tender, l_suppkey AS bidder, l_partkey AS material, month(l_shipdate) AS round,
    l_extendedprice / l_quantity AS price, CASE WHEN l_returnflag = 'A' THEN 'S' ELSE 'N' END AS winner
    FROM lineitem WHERE l_linestatus = 'O'),
lotted AS (SELECT o_orderkey AS tender, '00000001' AS lot FROM orders WHERE o_orderstatus = 'F'),
settled AS (SELECT l_orderkey AS tender, CAST(l_linenumber AS BIGINT) AS line, l_suppkey AS bidder FROM lineitem WHERE l_tax = 0.08),
request AS (SELECT o_orderkey AS number, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS type FROM orders),
request_line AS (SELECT l_orderkey AS request, l_partkey AS material, l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'A'),
request_tender AS (SELECT o_orderkey AS request, o_orderkey AS tender FROM orders),
price_adjustment AS (SELECT l_orderkey AS tender, l_partkey AS material, l_extendedprice / l_quantity AS unit_price,
    CAST(l_shipdate AS DATE) AS starts FROM lineitem WHERE l_returnflag <> 'R'),
purchase_order AS (SELECT o_orderkey AS number, year(o_orderdate) AS year, o_custkey AS doc_number,
    CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS sub_number, o_custkey AS commitment, CAST(o_orderdate AS DATE) AS issued,
    o_custkey AS supplier, o_orderpriority AS payment_terms, month(o_orderdate) AS m,
    CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS tender, o_custkey + 100 AS unit,
    CASE WHEN o_orderstatus = 'P' THEN o_orderkey - 1 END AS parent, o_custkey AS store,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS contract_number FROM orders),
order_line AS (SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS material, l_quantity AS quantity,
    l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total FROM lineitem),
annulled AS (SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, SUM(l_quantity) AS annulled_quantity,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,8))) AS DOUBLE) AS annulled_value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
register_tenders AS (SELECT o_orderkey AS tender FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000),
commitment AS (SELECT c_custkey AS number, c_acctbal AS amount, CASE WHEN c_mktsegment = 'BUILDING' THEN 1997 END AS carried_year
    FROM customer),
loaded_items AS (SELECT l_orderkey AS tender, CAST(l_linenumber AS BIGINT) AS line,
    '001.' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code FROM lineitem WHERE l_linestatus = 'O'),
vehicle_type AS (SELECT DISTINCT (ascii(p_type) - 64) * 10 + length(p_type) AS number, p_type AS name FROM part),
vehicle AS (SELECT p_partkey AS number, split_part(p_name, ' ', 1) || split_part(p_name, ' ', 2) AS plate, p_name AS name,
    p_type AS colour, CAST(p_size AS BIGINT) AS built, CAST(NULLIF(p_size, 50) AS BIGINT) AS model_year,
    DATE '1995-01-01' + CAST(floor(p_retailprice) AS INTEGER) AS acquired, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS make,
    (ascii(p_type) - 64) * 10 + length(p_type) AS vehicle_type, p_size AS fuel_type, p_retailprice AS km FROM part),
purchases AS (SELECT * FROM events WHERE event_type = 'purchase'),
inventory AS (SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, l_suppkey AS store, l_partkey AS material,
    SUM(l_quantity) AS balance, CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,8))) AS DOUBLE) / SUM(l_quantity) AS price
    FROM lineitem GROUP BY 1, 2, 3, 4),
known_codes AS (SELECT material, code FROM item_codes JOIN part ON p_partkey = material WHERE p_size <= 45),
movement_line AS (SELECT l_orderkey AS movement, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS material, l_quantity AS quantity,
    l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total,
    CASE WHEN l_returnflag = 'N' THEN 'S' WHEN l_linestatus = 'O' THEN 'N' END AS direct FROM lineitem WHERE l_returnflag <> 'R'),
asset AS (SELECT c_custkey AS number, c_name AS asset_plate, c_mktsegment AS name,
    (ascii(c_mktsegment) - 64) * 10 + length(c_mktsegment) AS asset_kind, CAST(c_nationkey AS BIGINT) AS condition,
    DATE '1995-01-01' + c_nationkey AS entered, c_acctbal AS acquisition_value,
    CASE WHEN c_acctbal < 0 THEN (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) END AS closed,
    CASE WHEN c_acctbal < 0 THEN CAST(c_nationkey AS VARCHAR) END AS writeoff_mode, CASE WHEN c_acctbal < 0 THEN 'X' END AS writeoff_reason,
    CASE WHEN c_acctbal < -500 THEN c_acctbal END AS writeoff_value FROM customer),
asset_placement AS (SELECT o_custkey AS asset, o_orderkey AS sequence,
    100 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 10 + month(o_orderdate) AS unit, CAST(o_orderdate AS DATE) AS started,
    CASE WHEN o_orderstatus = 'P' THEN 'A' WHEN o_orderpriority <> '5-LOW' THEN 'T' END AS movement FROM orders),
asset_valuation AS (SELECT o_custkey AS asset, CAST(o_orderdate AS DATE) AS valued, o_totalprice AS base_value,
    o_totalprice / 2 AS residual, CASE WHEN o_orderstatus = 'O' THEN 'S' ELSE 'N' END AS revalued FROM orders WHERE o_orderstatus <> 'P'),
depreciation AS (SELECT user_id AS asset, CAST(ts AS DATE) AS valued, value, month(ts) AS month, year(ts) AS year
    FROM events WHERE event_type = 'error')
"""
