"""Asset plans against SQL."""

from checks.binding import ENTITIES, PARAMS, Entities
from checks.registry import EXACT, GROW, query
from ledgerlift.plans import assets

W = f"WITH {ENTITIES}"
COMPANY = "CAST(1 AS BIGINT) AS company"


@query(
    W + f"""SELECT DISTINCT writeoff_mode AS code, {COMPANY},
    CASE WHEN COALESCE(writeoff_value, 0) <> 0 THEN 'ALIENACAO' ELSE 'BAIXA' END AS description
    FROM asset WHERE writeoff_reason IS NOT NULL"""
)
def p_writeoff_reasons(t):
    return assets.writeoff_reasons(Entities(t).asset, PARAMS)


@query(f"SELECT s_suppkey AS code, {COMPANY}, s_name AS description FROM supplier")
def p_conditions(t):
    return assets.conditions(Entities(t).asset_condition, PARAMS)


@query(
    f"""SELECT DISTINCT (ascii(c_mktsegment) - 64) * 10 + length(c_mktsegment) AS code, {COMPANY}, c_mktsegment AS description
    FROM customer"""
)
def p_asset_kinds(t):
    return assets.asset_kinds(Entities(t).asset_kind, PARAMS)


HIDDEN = "CASE active WHEN 'S' THEN 'N' ELSE 'S' END AS hidden"


@query(W + f"SELECT {COMPANY}, number AS code, substr(name, 1, 60) AS name, {HIDDEN} FROM org_unit WHERE parent IS NULL")
def p_departments(t):
    return assets.departments(Entities(t).org_unit, PARAMS)


@query(
    W + f"""SELECT number AS code, {COMPANY}, parent AS department, substr(name, 1, 60) AS name, {HIDDEN} FROM org_unit
    WHERE parent IS NOT NULL AND EXISTS (SELECT 1 FROM asset_placement p WHERE p.unit = number)"""
)
def p_sectors(t):
    e = Entities(t)
    return assets.sectors(e.org_unit, e.asset_placement, PARAMS)


REGISTER = """,
first_place AS (SELECT asset, arg_min(unit, sequence) AS unit FROM asset_placement WHERE COALESCE(movement, 'A') = 'A' GROUP BY 1),
last_place AS (SELECT asset, unit FROM asset_placement WHERE (asset, sequence) IN
    (SELECT asset, MAX(sequence) FROM asset_placement GROUP BY 1)),
slots AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset, revalued
    ORDER BY valued DESC NULLS FIRST, base_value DESC, residual DESC) AS rn FROM asset_valuation) WHERE rn = 1),
kept AS (SELECT a.*, f.unit, l.unit AS current_unit, COALESCE(s.residual, n.residual) AS residual,
    row_number() OVER (ORDER BY number) AS n FROM asset a LEFT JOIN first_place f ON f.asset = number
    LEFT JOIN last_place l ON l.asset = number LEFT JOIN slots s ON s.asset = number AND s.revalued = 'S'
    LEFT JOIN slots n ON n.asset = number AND n.revalued = 'N' WHERE f.asset IS NOT NULL OR l.asset IS NULL),
register AS (SELECT number AS asset, CAST(1 AS BIGINT) AS company, '001' AS asset_group, """ + GROW.format('n', 6) + """ AS plate,
    'A' || asset_kind AS account, unit, current_unit, 'C' AS origin, asset_kind, condition, name AS description,
    CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS DATE) AS acquired, entered AS launched, acquisition_value,
    CAST(0 AS DOUBLE) AS current_value, CAST(NULL AS BIGINT) AS supplier, asset_plate AS invoice,
    CAST(NULL AS DOUBLE) AS quantity_share, 'V' AS depreciation_basis, residual, 'M' AS depreciation_cycle,
    CAST(NULL AS VARCHAR) AS commitment, year(entered) AS commitment_year, closed, number || asset_plate AS sync_key,
    TRY_CAST(writeoff_mode AS BIGINT) AS writeoff_code, asset_plate AS former_plate, CAST(NULL AS DATE) AS accounted FROM kept)
"""
LEDGER = """,
entries AS (SELECT p.asset, started AS dated, movement AS kind, CASE WHEN movement = 'T' THEN 0 ELSE base_value END AS value, unit,
    CASE WHEN movement = 'T' THEN 'TRANSFERENCIA' ELSE 'AQUISICAO' END AS history, 'N' AS depreciation FROM asset_placement p
    JOIN (SELECT asset, base_value FROM (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY valued NULLS FIRST,
        base_value DESC NULLS LAST) AS nr FROM asset_valuation WHERE revalued = 'N') WHERE nr = 1) v USING (asset)
    UNION ALL SELECT asset, valued, 'R', -value, NULL, 'DEPRECIACAO ' || month || '-' || year, 'S' FROM depreciation
    UNION ALL SELECT asset, MAX(valued), 'R', MAX(base_value) - MIN(base_value), NULL, 'REAVALIACAO', 'N' FROM asset_valuation
    GROUP BY 1 HAVING COUNT(*) > 1),
ledger AS (SELECT row_number() OVER (ORDER BY dated, asset, kind NULLS LAST, history, value, unit NULLS LAST, depreciation) AS movement, *
    FROM entries)
"""
BALANCE = REGISTER + LEDGER + """,
revalued AS (SELECT asset, MAX(dated) AS last_date FROM ledger WHERE kind = 'R' AND depreciation <> 'S' GROUP BY 1),
totals AS (SELECT asset, """ + EXACT.format("value") + """ AS total FROM ledger GROUP BY 1),
balances AS (SELECT r.* EXCLUDE (launched, accounted, current_value), COALESCE(last_date, launched) AS launched,
    COALESCE(last_date, closed, launched) AS accounted, COALESCE(total, 0) AS current_value
    FROM register r LEFT JOIN revalued USING (asset) LEFT JOIN totals USING (asset))
"""


def _register(e):
    return assets.assets(e.asset, e.asset_placement, e.asset_valuation, e.asset_kind, PARAMS)


def _ledger(e):
    return assets.ledger(e.asset_placement, e.asset_valuation, e.depreciation, PARAMS)


@query(W + REGISTER + "SELECT * FROM register")
def p_assets(t):
    return _register(Entities(t))


LEDGER_SQL = W + LEDGER + f"SELECT *, {COMPANY}, dated AS accounted, movement AS sync_key FROM ledger"


@query(LEDGER_SQL)
def p_asset_ledger(t):
    return _ledger(Entities(t))


@query(LEDGER_SQL)
def asset_ledger(t):
    return _ledger(Entities(t))


@query(W + BALANCE + "SELECT * FROM balances")
def p_asset_balance(t):
    e = Entities(t)
    return assets.balances(_register(e), assets.ledger_rows(e.asset_placement, e.asset_valuation, e.depreciation))


@query(
    W + BALANCE + f"""SELECT (SELECT MAX(movement) FROM ledger) + row_number() OVER (ORDER BY asset) AS movement, {COMPANY}, asset,
    closed AS dated, 'B' AS kind, current_value AS value, current_unit AS unit, 'BAIXA' AS history, 'N' AS depreciation,
    closed AS accounted, CAST(NULL AS BIGINT) AS sync_key FROM balances WHERE closed IS NOT NULL"""
)
def p_asset_writeoffs(t):
    e = Entities(t)
    movements = _ledger(e)
    return assets.writeoffs(assets.balances(_register(e), movements), movements)
