"""One query per operator, on the given tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import EXACT, Tables, query
from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.functions import values as V
from ledgerlift.operators import audit, changes, lookups, numbering, picks
from ledgerlift.session import scratch_path
from ledgerlift.sources import reader, writer

FY = 1998
KEY5 = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
KEY5_SQL = ", ".join(KEY5)
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship_day"
MONEY = EXACT
MODALITY_VALUES = ", ".join(f"({n}, '{name}', '{code}', {target})" for n, name, code, target in K.MODALITIES)
KIND_VALUES = ", ".join(f"('{k}', '{d}')" for k, d in K.MOVEMENT_KINDS)
OUTSIDE_SQL = (
    r"[^\x{00}-\x{7F}\x{A0}-\x{FF}"
    + "".join(rf"\x{{{ord(c):04X}}}" for c in X.CODE_PAGE_EXTRA + X.CODE_PAGE_CONTROLS)
    + "]"
)


def line():
    """The key of a line item, its ship day as a date."""
    return [*KEY5[:4], F.to_date("l_shipdate").alias("ship_day")]


def key_order(*columns: str):
    return [F.col(c).asc_nulls_last() for c in columns]


def unit_price():
    return F.col("l_extendedprice") / F.col("l_quantity")


def order_year():
    return F.year("o_orderdate").cast("bigint")


def modalities(t: Tables):
    return t.spark.createDataFrame(K.MODALITIES, K.MODALITY_SCHEMA)


# ---- sources and sinks -------------------------------------------------------


@query("SELECT * FROM part")
def src_scan(t):
    return t.part


@query(f"SELECT {LINE_SQL}, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def lookup_reload(t):
    path = scratch_path(t.spark, "brands")
    writer.refresh(t.part.select("p_partkey", "p_brand").distinct(), path)
    loaded = t.spark.read.parquet(path)
    return lookups.lookup(t.lineitem.select(*KEY5), loaded, {"l_partkey": "p_partkey"}, ["p_brand"], "fail").select(
        *line(), "p_brand"
    )


def _orders_by_year(t):
    return t.orders.withColumn("order_year", order_year())


def _year_totals(df):
    return df.groupBy(F.col("order_year").cast("bigint").alias("order_year")).agg(
        F.count("*").alias("n_rows"), V.exact_sum(F.col("o_totalprice")).alias("total")
    )


@query(
    f"""SELECT year(o_orderdate) AS order_year, 2 * COUNT(*) AS n_rows,
    2 * {MONEY.format('o_totalprice')} AS total FROM orders GROUP BY 1"""
)
def snk_append(t):
    path = scratch_path(t.spark, "orders")
    for _ in range(2):
        writer.append(_orders_by_year(t), path, ["order_year"])
    return _year_totals(t.spark.read.parquet(path))


@query(
    f"""SELECT year(o_orderdate) AS order_year, COUNT(*) AS n_rows,
    {MONEY.format('o_totalprice')} AS total FROM orders GROUP BY 1"""
)
def snk_refresh(t):
    folder = scratch_path(t.spark, "module")
    for _ in range(2):
        writer.refresh_module({"orders": _orders_by_year(t)}, folder)
    return _year_totals(t.spark.read.parquet(f"{folder}/orders"))


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders"""
)
def replace_where(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    part = F.col("o_orderstatus") == "P"
    return changes.replace_slice(orders, orders.filter(part).withColumn("o_orderstatus", F.lit("X")), part)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def drop_orphans(t):
    return changes.drop_orphans(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"})


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS legacy_key FROM customer")
def add_column(t):
    return changes.add_text_column(t.customer.select("c_custkey", "c_name"), "legacy_key")


@query(
    f"""WITH modality(code, label, short_code, target) AS (VALUES {MODALITY_VALUES}),
    kind(code, label) AS (VALUES {KIND_VALUES})
    SELECT 'modality' AS list, CAST(code AS VARCHAR) AS code, label,
        (SELECT COUNT(*) FROM part WHERE p_size = code) AS used FROM modality
    UNION ALL SELECT 'movement', code, label, (SELECT COUNT(*) FROM lineitem WHERE l_returnflag = code) FROM kind
    UNION ALL SELECT 'adjustment', '1', '{K.ADJUSTMENT_KIND[1]}', (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'group', '1', '{K.ASSET_GROUP[1]}', (SELECT COUNT(*) FROM customer)"""
)
def seed_dimension(t):
    """The four constant lists with the number of rows that use each entry."""
    modality = modalities(t).select(
        F.lit("modality").alias("list"), F.col("modality").cast("string").alias("code"),
        F.col("modality_name").alias("label"),
    )
    kind = t.spark.createDataFrame(K.MOVEMENT_KINDS, K.MOVEMENT_KIND_SCHEMA).select(
        F.lit("movement").alias("list"), F.col("kind").alias("code"), F.col("description").alias("label")
    )
    single = t.spark.createDataFrame(
        [("adjustment", str(K.ADJUSTMENT_KIND[0]), K.ADJUSTMENT_KIND[1]), ("group", str(K.ASSET_GROUP[0]), K.ASSET_GROUP[1])],
        "list string, code string, label string",
    )
    used = (
        t.part.select(F.lit("modality").alias("list"), F.col("p_size").cast("string").alias("code"))
        .unionByName(t.lineitem.select(F.lit("movement").alias("list"), F.col("l_returnflag").alias("code")))
        .unionByName(t.orders.filter("o_orderstatus = 'O'").select(F.lit("adjustment").alias("list"), F.lit("1").alias("code")))
        .unionByName(t.customer.select(F.lit("group").alias("list"), F.lit("1").alias("code")))
        .groupBy("list", "code")
        .agg(F.count("*").alias("used"))
    )
    seeds = modality.unionByName(kind).unionByName(single)
    return seeds.join(used, ["list", "code"], "left").withColumn("used", F.coalesce("used", F.lit(0).cast("bigint")))


@query(
    """SELECT s_suppkey, s_name, s_nationkey FROM supplier
    UNION ALL SELECT -1, 'DEFAULT', (SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT 1)"""
)
def sentinel_row(t):
    first = t.nation.orderBy("n_nationkey").limit(1).first()["n_nationkey"]
    return changes.with_sentinel(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), (-1, "DEFAULT", first))


def _year_lines(t):
    orders = t.orders.filter(V.in_year(F.col("o_orderdate"), FY)).select("o_orderkey", "o_custkey")
    return t.lineitem.select(*KEY5, "l_quantity").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    f"""SELECT o_orderkey, o_custkey, l_partkey AS first_part, l_suppkey AS first_supplier FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY {KEY5_SQL}) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = {FY}) WHERE rn = 1"""
)
def fan_out_header(t):
    return picks.first_per_key(_year_lines(t), ["o_orderkey"], key_order(*KEY5)).select(
        "o_orderkey", "o_custkey", F.col("l_partkey").alias("first_part"), F.col("l_suppkey").alias("first_supplier")
    )


@query(
    f"""SELECT o_custkey, {LINE_SQL}, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE year(o_orderdate) = {FY}"""
)
def fan_out_detail(t):
    return _year_lines(t).select("o_custkey", *line(), "l_quantity")


@query("SELECT s_suppkey AS code, s_name AS description FROM supplier")
def dim_projection(t):
    return t.supplier.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("description"))


@query(
    """SELECT 'lines' AS entity, COUNT(*) AS extracted, COUNT(*) FILTER (WHERE p_size <= 45) AS loaded,
    COUNT(*) FILTER (WHERE p_size > 45) AS rejected, TRUE AS balanced FROM lineitem JOIN part ON p_partkey = l_partkey"""
)
def reconcile_counts(t):
    lines, dim = t.lineitem.select("l_partkey"), t.part.filter("p_size <= 45")
    on = {"l_partkey": "p_partkey"}
    return audit.reconcile("lines", lines, lookups.lookup(lines, dim, on, ["p_brand"], "skip"), lookups.misses(lines, dim, on))


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal FROM customer")
def typed_contract(t):
    contract = T.StructType([
        T.StructField("c_custkey", T.LongType(), False),
        T.StructField("c_name", T.StringType(), False),
        T.StructField("c_nationkey", T.LongType()),
        T.StructField("c_acctbal", T.DecimalType(18, 2)),
    ])
    good, _ = reader.conform(t.customer, contract)
    return good.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice <> round(o_totalprice, 1) OR o_orderdate <> CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)"""
)
def typed_contract_rejects(t):
    """Amounts that one place cannot hold, and days with a time of day, do not fit."""
    contract = T.StructType([
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_totalprice", T.DecimalType(18, 1)),
        T.StructField("o_orderdate", T.DateType()),
    ])
    return reader.conform(t.orders, contract)[1].select("o_orderkey", "o_totalprice")


# ---- projections, filters, predicates ---------------------------------------


@query(
    """SELECT o_orderkey AS id, o_totalprice AS amount, 'EC' AS status, 'S' AS released,
    CAST(NULL AS VARCHAR) AS process FROM orders"""
)
def project_constants(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.lit("EC").alias("status"),
        F.lit("S").alias("released"), F.lit(None).cast("string").alias("process"),
    )


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'N' ELSE 'S' END AS hidden FROM orders")
def flag_inversion(t):
    return t.orders.select("o_orderkey", V.hidden_flag(F.when(F.col("o_orderstatus") == "F", "S")).alias("hidden"))


@query(
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' AND p_size <= 25 THEN 'P' WHEN p_type = 'SMALL' THEN 'E'
    WHEN p_type = 'PROMO' AND p_size <= 10 THEN 'S' WHEN p_type = 'LARGE' THEN 'S' ELSE 'P' END AS item_kind,
    CASE WHEN p_type = 'MEDIUM' THEN 'P' ELSE 'C' END AS item_use FROM part"""
)
def case_classify(t):
    kind, size = F.col("p_type"), F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when((kind == "SMALL") & (size <= 25), "P").when(kind == "SMALL", "E")
        .when((kind == "PROMO") & (size <= 10), "S").when(kind == "LARGE", "S").otherwise("P").alias("item_kind"),
        F.when(kind == "MEDIUM", "P").otherwise("C").alias("item_use"),
    )


def _returned():
    return F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))


@query(f"SELECT {LINE_SQL}, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS returned FROM lineitem")
def case_null(t):
    return t.lineitem.select(*line(), _returned().alias("returned"))


@query(f"SELECT {LINE_SQL}, COALESCE(CASE WHEN l_returnflag = 'R' THEN l_quantity END, 0) AS returned FROM lineitem")
def coalesce_default(t):
    return t.lineitem.select(*line(), F.coalesce(_returned(), F.lit(0.0)).alias("returned"))


@query(
    f"""SELECT 'current' AS period, COUNT(*) AS n FROM orders WHERE year(o_orderdate) = {FY}
    UNION ALL SELECT 'before', COUNT(*) FROM orders WHERE year(o_orderdate) < {FY}
    UNION ALL SELECT 'recent', COUNT(*) FROM orders WHERE year(o_orderdate) >= {FY - 1}"""
)
def filter_year(t):
    day = F.col("o_orderdate")
    periods = {"current": V.in_year(day, FY), "before": V.before_year(day, FY), "recent": V.from_year(day, FY - 1)}
    counts = [
        t.orders.filter(where).agg(F.count("*").alias("n")).select(F.lit(name).alias("period"), "n")
        for name, where in periods.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(f"SELECT {LINE_SQL} FROM lineitem WHERE year(l_shipdate) = {FY}")
def filter_date_year(t):
    return t.lineitem.filter(V.in_year(F.col("l_shipdate"), FY)).select(*line())


@query(
    """SELECT event_type, COUNT(*) FILTER (WHERE s_suppkey IS NULL) AS unknown,
    COUNT(*) FILTER (WHERE s_suppkey IS NOT NULL) AS known
    FROM events LEFT JOIN supplier ON s_suppkey = user_id GROUP BY 1"""
)
def null_filters(t):
    joined = t.events.join(t.supplier, F.col("s_suppkey") == F.col("user_id"), "left")
    return joined.groupBy("event_type").agg(
        F.count_if(F.col("s_suppkey").isNull()).alias("unknown"), F.count_if(F.col("s_suppkey").isNotNull()).alias("known")
    )


@query(f"SELECT {LINE_SQL}, l_returnflag FROM lineitem WHERE NULLIF(l_returnflag, 'N') <> 'R'")
def neq_3vl(t):
    return t.lineitem.filter(F.nullif(F.col("l_returnflag"), F.lit("N")) != "R").select(*line(), "l_returnflag")


@query(f"SELECT {LINE_SQL} FROM lineitem WHERE l_discount * l_extendedprice <> 0")
def expr_filter(t):
    return t.lineitem.filter(F.col("l_discount") * F.col("l_extendedprice") != 0).select(*line())


@query("SELECT p_partkey, contains(lower(p_name), 'ring') AS holds FROM part")
def contains_filter(t):
    holds = F.lower("p_name").contains("RING".lower())
    keep = t.part.filter(holds).select("p_partkey", F.lit(True).alias("holds"))
    return keep.unionByName(t.part.filter(~holds).select("p_partkey", F.lit(False).alias("holds")))


@query(
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, MAX(o_orderdate) FROM orders GROUP BY 1)"""
)
def latest_by_max(t):
    return picks.best_with_ties(t.orders, ["o_custkey"], "o_orderdate").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day")
    )


@query(
    """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
    COALESCE((SELECT MIN(s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey), -1) AS s_suppkey FROM nation"""
)
def any_one_lookup(t):
    one = picks.any_one(t.supplier, "s_nationkey", "s_suppkey")
    found = lookups.lookup(t.nation, one, {"n_nationkey": "s_nationkey"}, ["s_suppkey"], "null")
    return found.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"))


# ---- joins ---------------------------------------------------------------------


@query(
    """SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey"""
)
def join_inner(t):
    return (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )


@query(
    f"""SELECT {LINE_SQL}, l_quantity, pair_quantity FROM lineitem
    JOIN (SELECT l_orderkey, l_suppkey, SUM(l_quantity) AS pair_quantity FROM lineitem GROUP BY 1, 2)
    USING (l_orderkey, l_suppkey)"""
)
def join_composite(t):
    keys = ["l_orderkey", "l_suppkey"]
    pairs = picks.summed(t.lineitem, keys, F.sum("l_quantity").alias("pair_quantity"))
    return t.lineitem.join(pairs, keys).select(*line(), "l_quantity", "pair_quantity")


@query(
    f"""SELECT o_orderkey, n_lines, total FROM orders LEFT JOIN
    (SELECT l_orderkey, COUNT(*) AS n_lines, {MONEY.format('l_extendedprice')} AS total FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey"""
)
def join_left(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), V.exact_sum(F.col("l_extendedprice")).alias("total")
    )
    return t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", "n_lines", "total")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'")
def join_left_on_filter(t):
    finished = t.orders.filter("o_orderstatus = 'F'")
    return t.customer.join(finished, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", "o_orderkey")


@query(f"SELECT {LINE_SQL}, p_name FROM lineitem JOIN part ON p_partkey = l_partkey")
def join_using(t):
    lines = t.lineitem.withColumn("p_partkey", F.col("l_partkey"))
    return lines.join(t.part, "p_partkey").select(*line(), "p_name")


@query(
    """WITH slot AS (SELECT o_custkey, o_orderstatus, o_totalprice, row_number() OVER (
        PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    SELECT c_custkey, f.o_totalprice AS original, o.o_totalprice AS revalued,
        COALESCE(o.o_totalprice, f.o_totalprice) AS picked
    FROM customer LEFT JOIN slot f ON f.o_custkey = c_custkey AND f.o_orderstatus = 'F' AND f.rn = 1
    LEFT JOIN slot o ON o.o_custkey = c_custkey AND o.o_orderstatus = 'O' AND o.rn = 1"""
)
def variant_pick(t):
    latest = picks.first_per_key(
        t.orders.filter(F.col("o_orderstatus").isin("F", "O")),
        ["o_custkey", "o_orderstatus"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )
    slots = latest.groupBy("o_custkey").agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("original"),
        F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("revalued"),
    )
    return t.customer.join(slots, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "original", "revalued", F.coalesce("revalued", "original").alias("picked")
    )


RETURNED_SQL = "SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'"


def _returns(t):
    return t.lineitem.filter("l_returnflag = 'R'")


@query(f"SELECT o_orderkey FROM orders WHERE EXISTS ({RETURNED_SQL})")
def join_semi(t):
    return picks.matching(t.orders, _returns(t), {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE NOT EXISTS ({RETURNED_SQL})")
def join_anti(t):
    return picks.unmatched(t.orders, _returns(t), {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN
    (SELECT l_orderkey FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'N' LIMIT 1)"""
)
def join_anti_notin(t):
    return picks.unmatched(t.orders, t.lineitem.filter("l_returnflag = 'N'"), {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(
    """SELECT c.o_orderkey, p.o_orderkey AS parent, CAST(p.o_orderdate AS DATE) AS parent_day
    FROM orders c JOIN orders p ON p.o_orderkey = c.o_orderkey - 1 WHERE c.o_orderstatus = 'P'"""
)
def join_self_hierarchy(t):
    child = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", (F.col("o_orderkey") - 1).alias("parent"))
    parent = t.orders.select(F.col("o_orderkey").alias("parent"), F.to_date("o_orderdate").alias("parent_day"))
    return child.join(parent, "parent").select("o_orderkey", "parent", "parent_day")


def _rounds(t):
    brands = t.part.select("p_partkey", "p_brand")
    return t.lineitem.withColumn("round", F.month("l_shipdate").cast("bigint")).join(
        brands, F.col("p_partkey") == F.col("l_partkey")
    )


@query(
    f"""SELECT p_brand, round, {LINE_SQL} FROM (SELECT *, month(l_shipdate) AS round,
    rank() OVER (PARTITION BY p_brand, l_suppkey ORDER BY month(l_shipdate) DESC) AS rk
    FROM lineitem JOIN part ON p_partkey = l_partkey) WHERE rk = 1"""
)
def latest_round(t):
    return picks.best_with_ties(_rounds(t), ["p_brand", "l_suppkey"], "round").select("p_brand", "round", *line())


def _annulled(t):
    return picks.summed(
        _returns(t), ["l_orderkey", "l_partkey"],
        F.sum("l_quantity").alias("annulled"), V.exact_sum(F.col("l_extendedprice")).alias("annulled_value"),
    )


ANNULLED_SQL = f"""(SELECT l_orderkey, l_partkey, SUM(l_quantity) AS annulled,
    {MONEY.format('l_extendedprice')} AS annulled_value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)"""


@query(f"SELECT {LINE_SQL}, annulled FROM lineitem LEFT JOIN {ANNULLED_SQL} USING (l_orderkey, l_partkey)")
def join_preagg(t):
    return t.lineitem.join(_annulled(t), ["l_orderkey", "l_partkey"], "left").select(*line(), "annulled")


@query(
    f"""SELECT o_custkey, l_partkey, SUM(l_quantity - COALESCE(annulled, 0)) AS quantity,
    {MONEY.format('l_extendedprice')} - {MONEY.format('COALESCE(annulled_value, 0)')} AS value
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN {ANNULLED_SQL} USING (l_orderkey, l_partkey)
    WHERE year(o_orderdate) < {FY} GROUP BY 1, 2"""
)
def prior_balance(t):
    orders = t.orders.filter(V.before_year(F.col("o_orderdate"), FY)).select("o_orderkey", "o_custkey")
    lines = t.lineitem.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    net = lines.join(_annulled(t), ["l_orderkey", "l_partkey"], "left")
    return net.groupBy("o_custkey", "l_partkey").agg(
        F.sum(F.col("l_quantity") - F.coalesce("annulled", F.lit(0.0))).alias("quantity"),
        (V.exact_sum(F.col("l_extendedprice")) - V.exact_sum(F.coalesce("annulled_value", F.lit(0.0)))).alias("value"),
    )


SMALL_SQL = f"FROM lineitem {{}} JOIN (SELECT * FROM part WHERE p_size <= 45) ON p_partkey = l_partkey"
PART_KEY = {"l_partkey": "p_partkey"}


def _small(t):
    return t.part.filter("p_size <= 45")


@query(f"SELECT {LINE_SQL}, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey")
def lookup_fail(t):
    return lookups.lookup(t.lineitem, t.part, PART_KEY, ["p_brand"], "fail").select(*line(), "p_brand")


@query(f"SELECT {LINE_SQL}, COALESCE(p_brand, '') AS p_brand {SMALL_SQL.format('LEFT')}")
def lookup_blank(t):
    return lookups.lookup(t.lineitem, _small(t), PART_KEY, ["p_brand"], "blank").select(*line(), "p_brand")


@query(f"SELECT {LINE_SQL}, p_brand {SMALL_SQL.format('')}")
def lookup_skip(t):
    return lookups.lookup(t.lineitem, _small(t), PART_KEY, ["p_brand"], "skip").select(*line(), "p_brand")


@query(f"SELECT {LINE_SQL}, COALESCE(p_retailprice, 0) AS p_retailprice {SMALL_SQL.format('LEFT')} WHERE COALESCE(p_retailprice, 0) <> 0")
def lookup_zero(t):
    found = lookups.lookup(t.lineitem, _small(t), PART_KEY, ["p_retailprice"], "zero")
    return found.filter("p_retailprice <> 0").select(*line(), "p_retailprice")


@query("SELECT p_name, MIN(p_partkey) AS p_partkey, COUNT(*) AS n FROM part GROUP BY 1 HAVING COUNT(*) > 1")
def lookup_dedupe(t):
    kept = lookups.unique_keys(t.part, ["p_name"], ["p_partkey"])
    twice = lookups.duplicate_keys(t.part, ["p_name"]).withColumnRenamed("rows", "n")
    return kept.join(twice, "p_name").select("p_name", "p_partkey", "n")


@query(
    f"""WITH m(modality, modality_name, short_code, modality_code) AS (VALUES {MODALITY_VALUES})
    SELECT p_partkey, modality_name, short_code, CAST(modality_code AS BIGINT) AS modality_code
    FROM part JOIN m ON modality = p_size"""
)
def lookup_constant(t):
    found = lookups.lookup(
        t.part, modalities(t), {"p_size": "modality"}, ["modality_name", "short_code", "modality_code"], "skip"
    )
    return found.select("p_partkey", "modality_name", "short_code", F.col("modality_code").cast("bigint").alias("modality_code"))


# ---- aggregations --------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, l_partkey, l_returnflag,
    CAST(l_linenumber AS BIGINT) AS line, SUM(l_quantity) AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""
)
def agg_sum_wide(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", "l_partkey", "l_returnflag",
        F.col("l_linenumber").cast("bigint").alias("line"),
    ).agg(F.sum("l_quantity").alias("quantity"))


@query("SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1")
def agg_max(t):
    return t.orders.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders WHERE o_orderstatus = 'O' GROUP BY 1")
def agg_max_filtered(t):
    return t.orders.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("last_day"))


@query("SELECT o_custkey, MAX(o_totalprice) - MIN(o_totalprice) AS spread FROM orders GROUP BY 1 HAVING COUNT(*) > 1")
def agg_having_range(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg((F.max("o_totalprice") - F.min("o_totalprice")).alias("spread"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )


@query(
    """SELECT l_orderkey, l_partkey, COALESCE(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0) AS quantity
    FROM lineitem GROUP BY 1, 2"""
)
def amendment_qty(t):
    added = F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))
    return t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.coalesce(F.sum(added), F.lit(0.0)).alias("quantity"))


def _open_totals(t):
    return t.orders.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(V.exact_sum(F.col("o_totalprice")).alias("total"))


OPEN_SQL = f"(SELECT o_custkey, {MONEY.format('o_totalprice')} AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)"


@query(
    f"""SELECT c_custkey, COALESCE(total, c_acctbal) AS c_acctbal FROM customer LEFT JOIN
    (SELECT o_custkey, {MONEY.format('o_totalprice')} AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey"""
)
def merge_total(t):
    totals = t.orders.groupBy("o_custkey").agg(V.exact_sum(F.col("o_totalprice")).alias("total"))
    target = t.customer.select("c_custkey", "c_acctbal")
    return changes.merge_matched(target, totals, {"c_custkey": "o_custkey"}, {"c_acctbal": "total"})


@query("SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_partkey").distinct()


@query("SELECT o_orderstatus, year(o_orderdate) AS order_year, COALESCE(MAX(o_orderkey), 0) AS last_number FROM orders GROUP BY 1, 2")
def last_number_register(t):
    return t.orders.groupBy("o_orderstatus", order_year().alias("order_year")).agg(
        F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("last_number")
    )


# ---- picks and numbering ---------------------------------------------------------


@query("SELECT p_name, MIN(p_partkey) AS p_partkey FROM part GROUP BY 1")
def dedupe_first(t):
    return picks.first_per_key(t.part, ["p_name"], key_order("p_partkey")).select("p_name", "p_partkey")


@query(
    """SELECT p_name, p_partkey, CAST(p_size AS BIGINT) AS p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_name
    ORDER BY p_size DESC NULLS FIRST, p_retailprice DESC NULLS FIRST, p_partkey) AS rn FROM part) WHERE rn = 1"""
)
def dedupe_latest(t):
    order = [F.col("p_size").desc_nulls_first(), F.col("p_retailprice").desc_nulls_first(), F.col("p_partkey").asc()]
    return picks.first_per_key(t.part, ["p_name"], order).select("p_name", "p_partkey", F.col("p_size").cast("bigint").alias("p_size"))


OFFER_RANK = f"""row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice / l_quantity ASC NULLS LAST, {KEY5_SQL})"""


def _best_offers(lines):
    return picks.first_per_key(
        lines.withColumn("unit_price", unit_price()),
        ["l_orderkey", "l_linenumber"],
        [F.col("unit_price").asc_nulls_last(), *key_order(*KEY5)],
    )


@query(f"SELECT {LINE_SQL}, l_extendedprice / l_quantity AS unit_price FROM (SELECT *, {OFFER_RANK} AS rn FROM lineitem) WHERE rn = 1")
def best_offer(t):
    return _best_offers(t.lineitem).select(*line(), "unit_price")


@query(f"SELECT {LINE_SQL}, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS offers FROM lineitem")
def offer_count(t):
    return picks.with_group_count(t.lineitem, ["l_orderkey", "l_linenumber"], "offers").select(*line(), "offers")


@query(
    f"""WITH w AS (SELECT {KEY5_SQL}, l_extendedprice / l_quantity AS won FROM
    (SELECT *, {OFFER_RANK} AS rn FROM lineitem WHERE l_returnflag = 'A') WHERE rn = 1)
    SELECT {LINE_SQL}, won FROM lineitem LEFT JOIN w USING ({KEY5_SQL})"""
)
def quote_winner(t):
    winners = _best_offers(t.lineitem.filter("l_returnflag = 'A'")).select(*KEY5, F.col("unit_price").alias("won"))
    return t.lineitem.join(winners, KEY5, "left").select(*line(), "won")


LATEST_RANK = "row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate DESC NULLS FIRST, l_orderkey, l_linenumber)"


def _latest_price(t):
    return picks.latest_value(
        t.lineitem.withColumn("price", unit_price()),
        ["l_suppkey", "l_partkey"],
        "price",
        [F.col("l_shipdate").desc_nulls_first(), *key_order("l_orderkey", "l_linenumber")],
    )


@query(f"SELECT l_suppkey, l_partkey, l_extendedprice / l_quantity AS price FROM (SELECT *, {LATEST_RANK} AS rn FROM lineitem) WHERE rn = 1")
def amendment_price(t):
    return _latest_price(t)


@query("SELECT o_orderkey, year(o_orderdate) AS order_year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS n FROM orders")
def line_numbers(t):
    orders = t.orders.select("o_orderkey", order_year().alias("order_year"))
    return numbering.number_within(orders, ["order_year"], key_order("o_orderkey"), "n")


BLOCK = 100
OVERFLOW_SQL = f"""WITH coded AS (SELECT p_partkey, p_type, rn // {BLOCK} AS block, rn % {BLOCK} AS serial FROM
    (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn FROM part)),
    base AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS subgroup FROM (SELECT DISTINCT p_type FROM part)),
    opened AS (SELECT p_type, block, (SELECT MAX(subgroup) FROM base) + dense_rank() OVER (ORDER BY p_type, block) AS subgroup
    FROM (SELECT DISTINCT p_type, block FROM coded WHERE block > 0))"""


def _overflow(t):
    coded = numbering.block_codes(t.part.select("p_partkey", "p_type"), ["p_type"], key_order("p_partkey"), BLOCK)
    base = numbering.rank_all(t.part.select("p_type").distinct(), ["p_type"], "subgroup")
    opened = numbering.block_groups(coded, ["p_type"], numbering.highest(base, "subgroup"), "subgroup")
    return coded, base, opened


@query(
    OVERFLOW_SQL
    + """SELECT p_partkey, lpad(CAST(subgroup AS VARCHAR), 3, '0') || '.' || lpad(CAST(serial AS VARCHAR), 3, '0') AS code
    FROM coded JOIN (SELECT p_type, 0 AS block, subgroup FROM base UNION ALL SELECT * FROM opened) USING (p_type, block)"""
)
def overflow_codes(t):
    coded, base, opened = _overflow(t)
    groups = base.withColumn("block", F.lit(0).cast("bigint")).unionByName(opened)
    return coded.join(groups, ["p_type", "block"]).select(
        "p_partkey",
        X.join_strict(X.pad_grow(F.col("subgroup"), 3), F.lit("."), X.pad_grow(F.col("serial"), 3)).alias("code"),
    )


@query(OVERFLOW_SQL + "SELECT p_type, block, lpad(CAST(subgroup AS VARCHAR), 3, '0') AS subgroup FROM opened")
def overflow_subgroups(t):
    return _overflow(t)[2].select("p_type", "block", X.pad_grow(F.col("subgroup"), 3).alias("subgroup"))


@query(f"SELECT {LINE_SQL}, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS issue FROM lineitem")
def doc_reissue_rank(t):
    return numbering.rank_within(t.lineitem, ["l_suppkey"], ["l_orderkey"], "issue").select(*line(), "issue")


@query(f"SELECT {LINE_SQL}, dense_rank() OVER (ORDER BY l_orderkey, l_returnflag) AS id FROM lineitem")
def global_dense_id(t):
    return numbering.rank_all(t.lineitem.select(*KEY5, "l_returnflag"), ["l_orderkey", "l_returnflag"], "id").select(*line(), "id")


@query(f"SELECT {LINE_SQL}, row_number() OVER (ORDER BY l_shipdate, {KEY5_SQL}) AS id FROM lineitem")
def global_row_id(t):
    return numbering.number_all(t.lineitem.select(*KEY5), key_order("l_shipdate", *KEY5[:4]), "id").select(*line(), "id")


@query(
    """SELECT p_brand, lpad(CAST(row_number() OVER (ORDER BY p_brand) AS VARCHAR), 3, '0') AS code
    FROM (SELECT DISTINCT p_brand FROM part)"""
)
def running_code(t):
    numbered = numbering.number_all(t.part.select("p_brand").distinct(), key_order("p_brand"), "n")
    return numbered.select("p_brand", X.pad_grow(F.col("n"), 3).alias("code"))


@query(
    f"""WITH h AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS number FROM orders
    WHERE year(o_orderdate) = {FY})
    SELECT number, {LINE_SQL} FROM h JOIN lineitem ON l_orderkey = o_orderkey"""
)
def renumber_headers(t):
    headers = t.orders.filter(V.in_year(F.col("o_orderdate"), FY)).select("o_orderkey", "o_orderdate")
    numbered = numbering.number_all(headers, key_order("o_orderdate", "o_orderkey"), "number")
    return t.lineitem.join(numbered, F.col("l_orderkey") == F.col("o_orderkey")).select("number", *line())


@query(
    f"""SELECT id, l_orderkey, l_returnflag, l_suppkey AS first_supplier FROM (SELECT *,
    dense_rank() OVER (ORDER BY l_orderkey, l_returnflag) AS id,
    row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {KEY5_SQL}) AS rn FROM lineitem) WHERE rn = 1"""
)
def stock_headers(t):
    ids = numbering.rank_all(t.lineitem.select(*KEY5, "l_returnflag"), ["l_orderkey", "l_returnflag"], "id")
    return picks.first_per_key(ids, ["id"], key_order(*KEY5)).select(
        "id", "l_orderkey", "l_returnflag", F.col("l_suppkey").alias("first_supplier")
    )


@query(
    """SELECT (SELECT MAX(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS id, s_name AS name
    FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer"""
)
def sequence_continue(t):
    existing = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = numbering.continue_numbers(existing, "id", t.supplier, key_order("s_suppkey"))
    return existing.unionByName(new.select("id", F.col("s_name").alias("name")))


# ---- sorts, limits, set operations -------------------------------------------------


@query("SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def sorted_output(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").select(F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")
def first_one(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_custkey")


@query(
    """SELECT p_name AS name, p_partkey AS number, p_brand AS family FROM part
    UNION ALL SELECT s_name, s_suppkey, '9' FROM supplier"""
)
def union_two(t):
    parts = t.part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("number"), F.col("p_brand").alias("family"))
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("number"), F.col("s_name").alias("name"), F.lit(K.SERVICE_FAMILY).alias("family")
    )
    return parts.unionByName(suppliers)


@query(
    f"""SELECT 'E' AS kind, {LINE_SQL}, l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT 'S', {LINE_SQL}, -l_quantity FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 'X', {LINE_SQL}, 0 FROM lineitem WHERE l_returnflag = 'N'"""
)
def union_three(t):
    def branch(flag, kind, quantity):
        return t.lineitem.filter(F.col("l_returnflag") == flag).select(F.lit(kind).alias("kind"), *line(), quantity.alias("quantity"))

    return (
        branch("A", "E", F.col("l_quantity"))
        .unionByName(branch("R", "S", -F.col("l_quantity")))
        .unionByName(branch("N", "X", F.lit(0.0)))
    )


@query("SELECT * FROM (SELECT DISTINCT p_type AS name FROM part) UNION ALL SELECT s_name FROM supplier")
def union_one_distinct(t):
    return t.part.select(F.col("p_type").alias("name")).distinct().unionByName(t.supplier.select(F.col("s_name").alias("name")))


# ---- scalar functions and cleanup -----------------------------------------------------


@query(
    """WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, CAST(o_orderkey AS VARCHAR) AS s FROM orders),
    n AS (SELECT *, CASE WHEN length(s) > 4 THEN s ELSE lpad(s, 4, '0') END || '/' || substr(CAST(y AS VARCHAR), 3, 2) AS doc FROM d)
    SELECT o_orderkey, doc, split_part(doc, '/', 1) AS serial, instr(doc, '/') AS slash_at, right(doc, 2) AS yy,
    lpad(s, 3, '0') AS cut, ' ' || CASE WHEN length(s) > 3 THEN s ELSE lpad(s, 3, '0') END AS signed,
    '001.' || substr(CAST(y AS VARCHAR), 2, 3) || '.' || lpad(s, 3, '0') AS item FROM n"""
)
def fmt_doc_number(t):
    key, year = F.col("o_orderkey"), order_year()
    doc = X.doc_number(key, year, 4)
    return t.orders.select(
        "o_orderkey", doc.alias("doc"), X.doc_serial(doc).alias("serial"),
        F.instr(doc, "/").cast("bigint").alias("slash_at"), F.right(doc, F.lit(2)).alias("yy"),
        X.pad_cut(key, 3).alias("cut"), X.pad_signed(key, 3).alias("signed"),
        X.item_code(F.lit("001"), F.substring(X.digits(year), 2, 3), X.pad_cut(key, 3)).alias("item"),
    )


@query(
    f"""SELECT {LINE_SQL}, COALESCE(NULLIF(l_returnflag, 'N'), '') || '-' || COALESCE(NULLIF(l_linestatus, 'F'), '') AS loose,
    NULLIF(l_returnflag, 'N') || '-' || NULLIF(l_linestatus, 'F') AS strict FROM lineitem"""
)
def concat_null_rules(t):
    a, b = F.nullif(F.col("l_returnflag"), F.lit("N")), F.nullif(F.col("l_linestatus"), F.lit("F"))
    return t.lineitem.select(
        *line(), X.join_loose(a, F.lit("-"), b).alias("loose"), X.join_strict(a, F.lit("-"), b).alias("strict")
    )


@query(
    """SELECT o_orderkey, year(o_orderdate) AS y, CAST(o_orderdate + INTERVAL 1 YEAR AS DATE) AS due,
    'DEPRECIACAO ' || month(o_orderdate) || '-' || year(o_orderdate) AS label FROM orders"""
)
def date_exprs(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", order_year().alias("y"), V.one_year_later(day).alias("due"),
        X.join_loose(F.lit(K.DEPRECIATION), F.month(day), F.lit("-"), F.year(day)).alias("label"),
    )


@query(
    f"""WITH c AS (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
        CAST(round(l_discount * 100) AS BIGINT) AS discount_cents FROM lineitem),
    -- the ratio in whole cents, half a cent rounded up, so that the SQL side is exact
    r AS (SELECT *, CASE WHEN discount_cents <> 0
    THEN ((200 * price_cents + discount_cents) // (2 * discount_cents)) / 100.0 ELSE 0 END AS ratio FROM c)
    SELECT {LINE_SQL}, ratio, abs(ratio * l_discount) AS back, l_extendedprice - l_tax AS less,
    l_orderkey % 1000 AS remainder, l_orderkey // 1000 AS whole FROM r"""
)
def safe_ratio(t):
    rows = t.lineitem.withColumn("ratio", V.safe_ratio(F.col("l_extendedprice"), F.col("l_discount")))
    return rows.select(
        *line(), "ratio", F.abs(F.col("ratio") * F.col("l_discount")).alias("back"),
        (F.col("l_extendedprice") - F.col("l_tax")).alias("less"), (F.col("l_orderkey") % 1000).alias("remainder"),
        F.floor(F.col("l_orderkey") / 1000).cast("bigint").alias("whole"),
    )


@query(
    """SELECT event_id, TRY_CAST(translate(props, '{}":k', '') AS BIGINT) AS parsed,
    TRY_CAST(props AS BIGINT) IS NULL AS rejected FROM events"""
)
def parse_number(t):
    return t.events.select(
        "event_id", X.parse_number(F.translate("props", '{}":k', "")).alias("parsed"),
        X.parse_number(F.col("props")).isNull().alias("rejected"),
    )


MARKED_SQL = "text || CASE WHEN lang = 'en' THEN '😀日' ELSE '€日' END"


def _marked(t):
    return t.documents.withColumn("text", F.concat("text", F.when(F.col("lang") == "en", "😀日").otherwise("€日")))


@query(f"SELECT doc_id, regexp_replace({MARKED_SQL}, '{OUTSIDE_SQL}', '', 'g') AS text FROM documents")
def sanitize_text(t):
    return _marked(t).select("doc_id", X.clean(F.col("text")).alias("text"))


@query(
    f"""SELECT lang, 'text' AS column_name, COUNT(*) FILTER (WHERE removed > 0) AS changed_rows,
    CAST(SUM(removed) AS BIGINT) AS removed_chars FROM (SELECT lang, length({MARKED_SQL})
    - length(regexp_replace({MARKED_SQL}, '{OUTSIDE_SQL}', '', 'g')) AS removed FROM documents) GROUP BY 1"""
)
def sanitize_audit(t):
    return audit.cleanup_audit(_marked(t), ["text"], "lang")


# ---- changes ---------------------------------------------------------------------------

CUSTOMER_KEY = {"c_custkey": "o_custkey"}


def _accounts(t):
    return t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")


@query(
    """SELECT c_custkey, CASE WHEN s.o_custkey IS NOT NULL THEN s.total ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN MAX(o_totalprice) > 300000 THEN MAX(o_totalprice) END AS total
    FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) s ON s.o_custkey = c_custkey"""
)
def merge_matched(t):
    top = F.max("o_totalprice")
    source = t.orders.filter("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.when(top > 300000, top).alias("total"))
    return changes.merge_matched(_accounts(t), source, CUSTOMER_KEY, {"c_acctbal": "total"})


@query(f"SELECT c_custkey, c_mktsegment, total AS c_acctbal FROM customer LEFT JOIN {OPEN_SQL} ON o_custkey = c_custkey")
def update_from_subquery(t):
    return changes.set_from(_accounts(t), _open_totals(t), CUSTOMER_KEY, "c_acctbal", "total")


@query(
    f"""SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN total ELSE c_acctbal END AS c_acctbal
    FROM customer LEFT JOIN {OPEN_SQL} ON o_custkey = c_custkey"""
)
def update_where(t):
    return changes.set_from_where(_accounts(t), _open_totals(t), CUSTOMER_KEY, "c_acctbal", "total", F.col("c_acctbal") < 0)


@query(
    """SELECT c_custkey, c_acctbal, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
    AND o_orderpriority = '1-URGENT') THEN 'URGENT' ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def update_exists(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return changes.set_if_exists(_accounts(t), urgent, CUSTOMER_KEY, {"c_mktsegment": F.lit("URGENT")})


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 0 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_acctbal < 1000 THEN CAST(CAST(c_acctbal * 100 AS BIGINT) AS VARCHAR) ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""
)
def update_self(t):
    old = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    return changes.set_where(_accounts(t), F.col("c_acctbal") < 1000, {"c_acctbal": F.lit(0.0), "c_mktsegment": old})


@query(
    f"""WITH award AS (SELECT * FROM (SELECT *, {OFFER_RANK} AS rn FROM lineitem) WHERE rn = 1),
    extra AS (SELECT l_orderkey, l_partkey, SUM(l_quantity) AS added FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
    price AS (SELECT l_suppkey, l_partkey, l_extendedprice / l_quantity AS price FROM
    (SELECT *, {LATEST_RANK} AS rn FROM lineitem) WHERE rn = 1),
    q AS (SELECT a.*, l_quantity + COALESCE(added, 0) AS quantity, price FROM award a
    LEFT JOIN extra USING (l_orderkey, l_partkey) LEFT JOIN price USING (l_suppkey, l_partkey))
    SELECT {LINE_SQL}, quantity, price, quantity * price AS total FROM q"""
)
def amendment_apply(t):
    awards = _best_offers(t.lineitem).select(*KEY5, F.col("l_quantity").alias("quantity"))
    extra = t.lineitem.filter("l_returnflag = 'A'").groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("added"))
    amended = lookups.lookup(awards, extra, {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey"}, ["added"], "zero")
    amended = amended.withColumn("quantity", F.col("quantity") + F.col("added"))
    priced = lookups.lookup(amended, _latest_price(t), {"l_suppkey": "l_suppkey", "l_partkey": "l_partkey"}, ["price"], "null")
    return priced.select(*line(), "quantity", "price", (F.col("quantity") * F.col("price")).alias("total"))


@query(
    """WITH e AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
    SELECT *, 'old' AS origin FROM e UNION ALL
    SELECT DISTINCT l_orderkey, l_linenumber, 'new' FROM lineitem a
    WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.l_orderkey = a.l_orderkey AND e.l_linenumber = a.l_linenumber)"""
)
def append_absent(t):
    keys = ["l_orderkey", "l_linenumber"]
    existing = _returns(t).select(*keys).distinct().withColumn("origin", F.lit("old"))
    new = _best_offers(t.lineitem).select(*keys).withColumn("origin", F.lit("new"))
    return changes.append_absent(existing, new, keys)


@query(
    f"""WITH m(modality, modality_name, short_code, modality_code) AS (VALUES {MODALITY_VALUES})
    SELECT o_orderkey, COALESCE(modality_name, o_orderpriority) AS o_orderpriority
    FROM orders LEFT JOIN m ON modality = CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 4"""
)
def update_from_dim(t):
    target = t.orders.select(
        "o_orderkey", "o_orderpriority", (F.substring("o_orderpriority", 1, 1).cast("int") * 4).alias("code")
    )
    named = changes.merge_matched(target, modalities(t), {"code": "modality"}, {"o_orderpriority": "modality_name"})
    return named.drop("code")


@query(
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderstatus, order_year) AS id FROM
    (SELECT DISTINCT o_orderstatus, year(o_orderdate) AS order_year FROM orders))
    SELECT o_orderkey, CASE WHEN orders.o_orderstatus <> 'P' THEN id END AS register_id FROM orders
    JOIN r ON r.o_orderstatus = orders.o_orderstatus AND order_year = year(o_orderdate)"""
)
def registry_fk(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", order_year().alias("order_year"), F.lit(None).cast("bigint").alias("register_id"))
    keys = ["o_orderstatus", "order_year"]
    register = numbering.number_all(orders.select(*keys).distinct(), key_order(*keys), "id")
    return changes.set_from_where(
        orders, register, {k: k for k in keys}, "register_id", "id", F.col("o_orderstatus") != "P"
    ).select("o_orderkey", "register_id")


@query(
    """WITH closed AS (SELECT c_custkey, c_acctbal, MAX(o_orderdate) AS closed_on FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE c_acctbal < 0 GROUP BY 1, 2)
    SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS id, c_custkey,
    CAST(closed_on AS DATE) AS day, c_acctbal AS value, 'BAIXA' AS history FROM closed"""
)
def writeoff_rows(t):
    last = t.orders.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("day"))
    closed = t.customer.filter("c_acctbal < 0").join(last, F.col("o_custkey") == F.col("c_custkey"))
    ledger = t.orders.select(F.col("o_orderkey").alias("id"))
    return numbering.continue_numbers(ledger, "id", closed, key_order("c_custkey")).select(
        "id", "c_custkey", "day", F.col("c_acctbal").alias("value"), F.lit(K.WRITE_OFF).alias("history")
    )


@query(
    """SELECT (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY p_name) AS centre, p_name AS plate,
    '000000001' AS store FROM (SELECT DISTINCT p_name FROM part)"""
)
def derive_dimension(t):
    centres = t.supplier.select(F.col("s_suppkey").alias("centre"))
    plates = t.part.select(F.col("p_name").alias("plate")).distinct()
    return numbering.continue_numbers(centres, "centre", plates, key_order("plate")).select(
        "centre", "plate", F.lit(K.DEFAULT_STORE).alias("store")
    )
