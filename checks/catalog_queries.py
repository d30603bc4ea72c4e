"""Catalog, organisation and quote plans against SQL."""

from checks.binding import ENTITIES, PARAMS, Entities
from checks.registry import EXACT, GROW, query
from ledgerlift import constants as K
from ledgerlift.plans import catalog, quotes

W = f"WITH {ENTITIES}"
ITEM_KIND_CASES = " ".join(f"WHEN parent_number = {n} AND parent_kind = '{kind}' THEN '{item}'" for n, kind, item in K.ITEM_KINDS)

GROUPS = """,
all_groups AS (SELECT kind, number, name FROM catalog_group WHERE level = 0
    UNION ALL SELECT '9', number, name FROM service_group),
coded_groups AS (SELECT lpad(CAST(row_number() OVER (ORDER BY kind, number) AS VARCHAR), 3, '0') AS group_code, * FROM all_groups)
"""
SUBGROUPS = GROUPS + """,
coded_subgroups AS (SELECT group_code, subgroup, s.name, s.kind, s.number FROM (
    SELECT DISTINCT parent_kind, parent_number, kind, number, name, substr(CAST(number AS VARCHAR), 2) AS subgroup
    FROM catalog_group WHERE level > 0
    UNION ALL SELECT '9', number, '9', number, name, '001' FROM service_group) s
    JOIN coded_groups g ON g.kind = s.parent_kind AND g.number = s.parent_number)
"""
ITEMS = SUBGROUPS + f""",
all_items AS (SELECT a.number AS material, group_kind AS kind, group_number AS number, a.name, CAST(min_stock AS DOUBLE) AS min_stock,
    CAST(max_stock AS DOUBLE) AS max_stock, CASE active WHEN 'S' THEN 'N' ELSE 'S' END AS hidden, unit_code,
    CASE {ITEM_KIND_CASES} ELSE 'P' END AS item_kind,
    CASE WHEN parent_kind = '2' THEN 'P' ELSE 'C' END AS item_use
    FROM catalog_item a JOIN catalog_group b ON b.kind = a.group_kind AND b.number = a.group_number
    UNION ALL SELECT number, '9', group_number, name, 0, 0, 'N', unit_code, 'P', 'C' FROM service_item),
numbered AS (SELECT *, row_number() OVER (PARTITION BY kind, number ORDER BY material) AS rn FROM all_items),
blocks AS (SELECT *, rn // {PARAMS.block_size} AS block, rn % {PARAMS.block_size} AS serial_no FROM numbered),
opened AS (SELECT kind, number, block, (SELECT MAX(CAST(subgroup AS BIGINT)) FROM coded_subgroups)
    + row_number() OVER (ORDER BY kind, number, block) AS opened FROM (SELECT DISTINCT kind, number, block FROM blocks WHERE block > 0)),
codes AS (SELECT b.*, s.group_code, lpad(CAST(serial_no AS VARCHAR), 3, '0') AS serial,
    CASE WHEN o.opened IS NULL THEN s.subgroup WHEN o.opened > 999 THEN CAST(o.opened AS VARCHAR)
    ELSE lpad(CAST(o.opened AS VARCHAR), 3, '0') END AS subgroup
    FROM blocks b JOIN coded_subgroups s USING (kind, number) LEFT JOIN opened o USING (kind, number, block))
"""


@query(W + "SELECT code, MIN(name) AS name FROM unit_of_measure GROUP BY 1")
def p_units(t):
    return catalog.units(Entities(t).unit_of_measure)


def _groups(e):
    return catalog.groups(e.catalog_group, e.service_group)


def _subgroups(e):
    return catalog.subgroups(e.catalog_group, e.service_group, _groups(e))


def _items(e):
    return catalog.items(e.catalog_item, e.catalog_group, e.service_item, _subgroups(e), PARAMS)


@query(
    W + GROUPS + """SELECT group_code, name, 'N' AS hidden, CAST(NULL AS VARCHAR) AS counter_entry,
    CAST(NULL AS VARCHAR) AS counter_exit, kind, number FROM coded_groups"""
)
def p_groups(t):
    return _groups(Entities(t))


@query(W + SUBGROUPS + "SELECT group_code, subgroup, name, 'N' AS hidden, kind, number, 'S' AS base FROM coded_subgroups")
def p_subgroups(t):
    return _subgroups(Entities(t))


@query(
    W + ITEMS + """SELECT group_code, subgroup, serial, group_code || '.' || subgroup || '.' || serial AS code,
    CASE WHEN kind = '9' THEN '9' ELSE '1' END AS family, material, name, min_stock, max_stock, hidden, unit_code,
    item_kind, item_use FROM codes"""
)
def p_items(t):
    return _items(Entities(t))["items"]


@query(
    W + ITEMS + """SELECT group_code, CASE WHEN opened > 999 THEN CAST(opened AS VARCHAR) ELSE lpad(CAST(opened AS VARCHAR), 3, '0') END
    AS subgroup, name, 'N' AS hidden, kind, number, 'N' AS base FROM opened JOIN coded_subgroups USING (kind, number)"""
)
def p_opened_subgroups(t):
    return _items(Entities(t))["opened_subgroups"]


@query(W + f"SELECT {GROW.format('number', 9)} AS code, name, CAST(1 AS BIGINT) AS company FROM store")
def p_destinations(t):
    return catalog.destinations(Entities(t).store, PARAMS)


@query(
    W + f""", head AS (SELECT authority, body FROM authority WHERE company = 1 ORDER BY authority, body LIMIT 1)
    SELECT number AS centre, substr(name, 1, 60) AS name, '001' AS sub_centre, CASE active WHEN 'S' THEN 'N' ELSE 'S' END AS hidden,
    CAST(1 AS BIGINT) AS company, (SELECT authority FROM head) AS authority, (SELECT body FROM head) AS body,
    COALESCE((SELECT {GROW.format('MIN(store)', 9)} FROM stock_request r WHERE r.unit = u.number), '000000001') AS store
    FROM org_unit u UNION ALL SELECT 0, NULL, '001', NULL, 1, authority, body, '000000001' FROM head"""
)
def p_cost_centres(t):
    e = Entities(t)
    return catalog.cost_centres(e.org_unit, e.stock_request, e.authority, PARAMS)


QUOTES = f""",
q AS (SELECT *, {GROW.format('doc_number', 5)} AS serial,
    {GROW.format('doc_number', 5)} || '/' || substr(CAST(year AS VARCHAR), 3, 2) AS doc
    FROM quote WHERE year = {PARAMS.fiscal_year}),
lines AS (SELECT quote, doc, line, material, brand, {EXACT.format('quantity')} AS quantity FROM q JOIN quote_line ON quote = number GROUP BY ALL),
coded_lines AS (SELECT quote, doc, line, code, quantity FROM lines JOIN item_codes USING (material)),
flagged AS (SELECT quote, line, bidder, MIN(price) AS won_price FROM quote_line WHERE lowest = 1 GROUP BY ALL),
prices AS (SELECT quote, doc, l.bidder, line, price AS unit_price, quantity * price AS total, brand, f.bidder AS winner, won_price
    FROM q JOIN quote_line l ON l.quote = q.number LEFT JOIN flagged f USING (quote, line, bidder))
"""


@query(
    W + QUOTES + """SELECT number AS quote, doc, serial, year, issued, subject AS description, subject AS notes,
    CAST(0 AS BIGINT) AS centre, 'EC' AS status, 'S' AS released, CAST(1 AS BIGINT) AS company, tender
    FROM q WHERE EXISTS (SELECT 1 FROM quote_line WHERE quote = number)"""
)
def p_quotes_header(t):
    e = Entities(t)
    return quotes.quote_headers(e.quote, e.quote_line, PARAMS)


@query(W + QUOTES + "SELECT quote, doc, line, code, quantity, CAST(0 AS DOUBLE) AS value, CAST(0 AS BIGINT) AS centre FROM coded_lines")
def p_quotes_lines(t):
    e = Entities(t)
    return quotes.quote_lines(e.quote, e.quote_line, e.item_codes, PARAMS)


def _bidders(e):
    return quotes.quote_bidders(e.quote, e.quote_line, e.person, PARAMS)


def _prices(e):
    return quotes.quote_prices(e.quote, e.quote_line, PARAMS)


@query(
    W + QUOTES + """SELECT DISTINCT quote, doc, bidder, substr(trim(p.name), 1, 70) AS name, CAST(0 AS DOUBLE) AS total
    FROM q JOIN quote_line l ON l.quote = q.number JOIN person p ON p.number = bidder"""
)
def p_quote_bidders(t):
    return _bidders(Entities(t))


@query(W + QUOTES + "SELECT *, 'GL' AS price_class FROM prices")
def p_quote_prices(t):
    return _prices(Entities(t))


@query(
    W + QUOTES + f"""SELECT DISTINCT quote, doc, bidder, substr(trim(p.name), 1, 70) AS name,
    (SELECT {EXACT.format('total')} FROM prices x WHERE x.quote = l.quote AND x.bidder = l.bidder) AS total
    FROM q JOIN quote_line l ON l.quote = q.number JOIN person p ON p.number = bidder"""
)
def p_quote_totals(t):
    e = Entities(t)
    return quotes.quote_totals(_bidders(e), _prices(e))


@query(
    W + QUOTES + """, w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY quote, line ORDER BY won_price, winner) AS rn
    FROM prices WHERE winner IS NOT NULL) WHERE rn = 1)
    SELECT quote, line, code, quantity, winner, COALESCE(won_price, 0) AS unit_price, won_price * quantity AS total,
    'M' AS kind, 'S' AS accepted FROM coded_lines LEFT JOIN (SELECT quote, line, winner, won_price FROM w) USING (quote, line)"""
)
def p_quote_awards(t):
    e = Entities(t)
    return quotes.quote_awards(quotes.quote_lines(e.quote, e.quote_line, e.item_codes, PARAMS), _prices(e))
