"""Order, stock and fleet plans against SQL."""

from checks.binding import ENTITIES, FLEET_PARAMS, PARAMS, Entities
from checks.registry import EXACT, GROW, query
from ledgerlift.plans import fleet, orders, stock

W = f"WITH {ENTITIES}"
YEAR = PARAMS.fiscal_year
YY = f"{YEAR % 100:02d}"

HEADERS = f""",
own AS (SELECT *, row_number() OVER (ORDER BY doc_number, number) AS n FROM purchase_order
    WHERE year = {YEAR} AND EXISTS (SELECT 1 FROM order_line WHERE order_id = number)),
docs AS (SELECT number AS order_id, {GROW.format('n', 5)} || '/{YY}' AS doc, {GROW.format('n', 5)} AS serial, * FROM own),
headers AS (SELECT h.order_id, h.doc, h.serial, h.year, h.supplier, h.issued, h.m AS budget_line, h.unit, 'S' AS delivered, h.tender,
    CAST(NULL AS VARCHAR) AS delivery_place, h.payment_terms, CAST(NULL AS VARCHAR) AS notes, CAST(1 AS BIGINT) AS company,
    {GROW.format('h.contract_number', 4)} || '/' || substr(CAST(h.year AS VARCHAR), 3, 2) AS contract,
    h.parent AS parent_order, p.doc AS parent_doc,
    CASE WHEN h.tender IN (SELECT tender FROM register_tenders) THEN CAST(0 AS BIGINT) END AS register_version,
    CASE WHEN h.sub_number = 0 THEN h.commitment END AS commitment, h.m AS expense_category, h.m AS expense_group,
    h.m AS expense_modality, h.m AS expense_element, CAST(NULL AS BIGINT) AS expense_detail, CAST(NULL AS BIGINT) AS link_group,
    ' ' || lpad(CAST(h.m AS VARCHAR), 3, '0') AS link_code, {GROW.format('h.store', 9)} AS store
    FROM docs h LEFT JOIN docs p ON p.order_id = h.parent),
funded AS (SELECT h.*, c.amount FROM headers h JOIN commitment c ON c.number = h.commitment
    WHERE carried_year IS NULL AND c.amount > 0)
"""


def _headers(e):
    return orders.order_headers(e.purchase_order, e.order_line, e.register_tenders, PARAMS)


@query(W + HEADERS + "SELECT * FROM headers")
def p_orders_header(t):
    return _headers(Entities(t))


@query(
    W + HEADERS + """SELECT doc, order_id, line, code, unit AS centre, quantity, unit_price, total, budget_line, expense_category,
    expense_group, expense_modality, expense_element, expense_detail, link_group, link_code, store, annulled_quantity, annulled_value
    FROM headers JOIN order_line USING (order_id) LEFT JOIN annulled USING (order_id, line) JOIN item_codes USING (material)"""
)
def p_orders_lines(t):
    e = Entities(t)
    return orders.order_lines(_headers(e), e.order_line, e.order_annulment, e.item_codes)


@query(
    W + HEADERS + """SELECT doc, budget_line, amount, expense_category, expense_group, expense_modality, expense_element,
    expense_detail, CAST(0 AS BIGINT) AS code, order_id, commitment FROM funded"""
)
def p_orders_commitment(t):
    e = Entities(t)
    return orders.order_commitments(_headers(e), e.commitment)


@query(
    W + HEADERS + """, used AS (SELECT commitment, MIN(order_id) AS order_id, arg_min(doc, order_id) AS order_doc FROM funded GROUP BY 1)
    SELECT number, amount, carried_year, order_id, order_doc FROM commitment c LEFT JOIN used ON used.commitment = c.number"""
)
def p_commitments(t):
    e = Entities(t)
    base = e.commitment.selectExpr("*", "CAST(NULL AS bigint) AS order_id", "CAST(NULL AS string) AS order_doc")
    return orders.committed(base, orders.order_commitments(_headers(e), e.commitment))


BALANCE = f""",
net AS (SELECT tender, material, {EXACT.format('quantity')} - {EXACT.format('COALESCE(annulled_quantity, 0)')} AS quantity,
    {EXACT.format('total')} - {EXACT.format('COALESCE(annulled_value, 0)')} AS value
    FROM purchase_order JOIN order_line ON order_id = number LEFT JOIN annulled USING (order_id, line)
    WHERE year < {YEAR} AND parent IS NULL AND tender IS NOT NULL GROUP BY 1, 2),
balance AS (SELECT CAST({YEAR - 1} AS BIGINT) AS year, tender, line, code, quantity, value FROM net JOIN item_codes USING (material)
    JOIN (SELECT tender, code, MIN(line) AS line FROM loaded_items GROUP BY 1, 2) USING (tender, code))
"""


def _balance(e):
    return orders.prior_balance(e.purchase_order, e.order_line, e.order_annulment, e.loaded_items, e.item_codes, PARAMS)


@query(W + BALANCE + "SELECT * FROM balance")
def p_prior_balance(t):
    return _balance(Entities(t))


@query(
    W + BALANCE + """SELECT year, line, code, quantity AS delivered, tender, value AS delivered_value FROM balance
    WHERE tender IN (SELECT tender FROM register_tenders)"""
)
def p_register_balance(t):
    e = Entities(t)
    return orders.register_balance(_balance(e), e.register_tenders)


# ---- fleet -------------------------------------------------------------------------


@query(
    """SELECT c_custkey AS code, substr(c_name, 1, 50) AS name, c_name AS licence, c_mktsegment AS licence_class,
    CAST(NULL AS DATE) AS licence_expires FROM customer"""
)
def p_drivers(t):
    e = Entities(t)
    return fleet.drivers(e.driver, e.holder)


@query(W + "SELECT number AS code, name AS description FROM vehicle_type")
def p_vehicle_types(t):
    return fleet.vehicle_types(Entities(t).vehicle_type)


@query(
    W + """SELECT number AS code, name AS description,
    COALESCE((SELECT MIN(vehicle_type) FROM vehicle v WHERE v.make = s.number), 1) AS vehicle_type FROM store s"""
)
def p_vehicle_makes(t):
    e = Entities(t)
    return fleet.vehicle_makes(e.store, e.vehicle)


VEHICLES = """,
vehicles AS (SELECT plate, v.number AS sequence, substr(v.name, 1, 45) AS model, CAST(NULL AS VARCHAR) AS chassis, colour, built,
    model_year, CAST(NULL AS VARCHAR) AS registration, acquired, CAST(NULL AS BIGINT) AS driver, make, km AS initial_km,
    CAST(NULL AS VARCHAR) AS notes, substr(n_name, 1, 1) AS fuel, CAST(NULL AS DATE) AS sold, CAST(NULL AS DATE) AS licensed_until,
    CAST(NULL AS DOUBLE) AS oil_change_km FROM (SELECT *, row_number() OVER (PARTITION BY plate
        ORDER BY model_year DESC NULLS FIRST, acquired DESC NULLS FIRST, number) AS rn FROM vehicle) v
    LEFT JOIN nation ON n_nationkey = fuel_type WHERE rn = 1),
centres AS (SELECT '02' AS authority, '01' AS body, '000000001' AS store, '001' AS sub_centre, model AS name,
    (SELECT MAX(number) FROM org_unit) + row_number() OVER (ORDER BY plate) AS centre, CAST(1 AS BIGINT) AS company, 'N' AS hidden, plate
    FROM vehicles)
"""


def _vehicles(e):
    return fleet.vehicles(e.vehicle, e.fuel_type)


def _centres(e):
    return fleet.vehicle_cost_centres(_vehicles(e), e.centre, FLEET_PARAMS)


@query(W + VEHICLES + "SELECT * FROM vehicles")
def p_vehicles(t):
    return _vehicles(Entities(t))


@query(W + VEHICLES + "SELECT * FROM centres")
def p_vehicle_cost_centres(t):
    return _centres(Entities(t))


FUEL = VEHICLES + """,
documents AS (SELECT CAST(1 AS BIGINT) AS company, event_id AS document, """ + GROW.format('event_id', 6) + """ || '/24' AS doc,
    """ + GROW.format('event_id', 6) + """ AS serial, year(ts) AS year, store, centre, CAST(ts AS DATE) AS dated,
    CAST(ts AS DATE) AS entered, CAST(ts AS DATE) AS paid, 'S' AS inbound, 'S' AS outbound, 'P' AS kind,
    CAST(NULL AS BIGINT) AS supplier, 'S' AS passes_through, user_id AS driver, value, plate
    FROM purchases JOIN vehicle v ON v.number = user_id JOIN centres USING (plate) WHERE year(ts) = 2024)
"""


def _fuelling(e):
    return fleet.fuelling(e.fuel_request, e.fuel_request_line, e.vehicle, _centres(e), e.item_codes, FLEET_PARAMS)


@query(W + FUEL + "SELECT * EXCLUDE (value, plate) FROM documents")
def p_fuel_header(t):
    return _fuelling(Entities(t))["headers"]


@query(
    W + FUEL + """SELECT document, doc, centre, company, item, code, value * item AS quantity_in, value * item AS quantity_out,
    value / 2 AS price_in, value / 2 AS price_out, value AS total_in, value AS total_out, store, value AS km, plate
    FROM documents JOIN item_codes ON material = driver, (VALUES (CAST(1 AS BIGINT)), (2)) line(item)"""
)
def p_fuel_lines(t):
    return _fuelling(Entities(t))["lines"]


# ---- stock -------------------------------------------------------------------------


@query(
    W + f"""SELECT CAST(0 AS BIGINT) AS document, '000000/{YY}' AS doc, CAST(0 AS BIGINT) AS centre, CAST(1 AS BIGINT) AS company,
    row_number() OVER (ORDER BY i.material, store) AS item, balance AS quantity_in, CAST(0 AS DOUBLE) AS quantity_out,
    price AS price_in, CAST(0 AS DOUBLE) AS price_out, balance * price AS total_in, CAST(0 AS DOUBLE) AS total_out,
    COALESCE(code, '') AS code, lpad(CAST(store AS VARCHAR), 9, '0') AS store
    FROM inventory i LEFT JOIN known_codes k ON k.material = i.material WHERE year = {YEAR - 1} AND month = 12 AND balance * price <> 0"""
)
def p_opening_stock(t):
    e = Entities(t)
    return stock.opening_stock(e.inventory, e.known_codes, PARAMS)["lines"]


STOCK = f""",
base AS (SELECT o_orderkey AS number, 'X' AS move, year(o_orderdate) AS year, o_custkey AS store, CAST(0 AS BIGINT) AS centre,
    CAST(o_orderdate AS DATE) AS dated, CAST(o_orderdate AS DATE) AS entered, CAST(o_orderdate AS DATE) AS paid, o_custkey AS supplier,
    line AS item, material, quantity, unit_price, total FROM orders JOIN movement_line ON movement = o_orderkey
    WHERE year(o_orderdate) = {YEAR} AND direct = 'S'
    UNION ALL SELECT o_orderkey, 'E', year(o_orderdate), o_custkey, 0, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE), NULL,
    o_custkey, line, material, quantity, unit_price, total FROM orders JOIN movement_line ON movement = o_orderkey
    WHERE year(o_orderdate) = {YEAR} AND direct <> 'S'
    UNION ALL SELECT number, 'S', year, store, unit, NULL, issued, issued, NULL, l_linenumber, l_partkey, l_quantity, 0, 0
    FROM stock_request JOIN lineitem ON l_orderkey = number AND l_returnflag = 'R' WHERE year = {YEAR} AND direct <> 'S'),
ids AS (SELECT *, dense_rank() OVER (ORDER BY number, move) AS document FROM base),
docs AS (SELECT *, CAST(1 AS BIGINT) AS company, {GROW.format('document', 6)} || '/{YY}' AS doc, {GROW.format('document', 6)} AS serial,
    lpad(CAST(store AS VARCHAR), 9, '0') AS store_code FROM ids)
"""


def _stock(e):
    return stock.stock_movements(
        e.movement, e.movement_line, e.stock_request, e.stock_request_line, e.known_codes, PARAMS
    )


@query(
    W + STOCK + """SELECT DISTINCT company, document, doc, serial, year, store_code AS store, centre, dated, entered, paid,
    CASE WHEN move = 'S' THEN 'N' ELSE 'S' END AS inbound, CASE WHEN move = 'E' THEN 'N' ELSE 'S' END AS outbound, 'P' AS kind,
    supplier, CASE WHEN move = 'X' THEN 'S' ELSE 'N' END AS passes_through FROM docs"""
)
def p_stock_header(t):
    return _stock(Entities(t))["headers"]


@query(
    W + STOCK + """SELECT document, doc, centre, company, item, CASE WHEN move = 'S' THEN 0 ELSE quantity END AS quantity_in,
    CASE WHEN move = 'E' THEN 0 ELSE quantity END AS quantity_out, CASE WHEN move = 'S' THEN 0 ELSE unit_price END AS price_in,
    CASE WHEN move = 'E' THEN 0 ELSE unit_price END AS price_out, CASE WHEN move = 'S' THEN 0 ELSE total END AS total_in,
    CASE WHEN move = 'E' THEN 0 ELSE total END AS total_out, COALESCE(code, '') AS code, store_code AS store
    FROM docs LEFT JOIN known_codes USING (material)"""
)
def p_stock_lines(t):
    return _stock(Entities(t))["lines"]
