"""Tender plans against SQL."""

from functools import cached_property

from checks.binding import ENTITIES, PARAMS, Entities
from checks.operator_queries import MODALITY_VALUES, OUTSIDE_SQL
from checks.registry import EXACT, GROW, query
from ledgerlift.plans import tenders
from ledgerlift.session import written_by

W = f"WITH {ENTITIES}"
YY = "substr(CAST(year AS VARCHAR), 3, 2)"

HEADERS = f""",
modality_list(modality, modality_name, short_code, modality_code) AS (VALUES {MODALITY_VALUES}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY process_number, number) AS n FROM tender),
headers AS (SELECT number AS tender, {GROW.format('n', 6)} || '/' || {YY} AS sequence,
    {GROW.format('process_number', 6)} || '/' || {YY} AS process, doc_number AS doc, year,
    CAST(3 AS BIGINT) AS mode, CAST(1 AS BIGINT) AS new_rules, 'S' AS released,
    regexp_replace(substr(subject, 1, 512), '{OUTSIDE_SQL}', '', 'g') AS description,
    regexp_replace(subject, '{OUTSIDE_SQL}', '', 'g') AS detail, price_register, CAST(0 AS BIGINT) AS small_firms,
    process_number, 'Menor Preco Unitario' AS criterion, dated, opened AS proposals_opened, substr(replace(open_time, ':', ''), 1, 4) AS open_time,
    substr(replace(delivery_time, ':', ''), 1, 4) AS delivery_time, 'Outros' AS publication, approved, substr(office, 1, 100) AS office,
    external_code, short_code, COALESCE(x.name, modality_name) AS modality_name, CAST(modality_code AS BIGINT) AS modality_code,
    published, closed, substr(replace(close_time, ':', ''), 1, 4) AS close_time, amount, CAST(1 AS BIGINT) AS company
    FROM numbered JOIN modality_list USING (modality) LEFT JOIN modality_names x ON x.code = modality_code),
register AS (SELECT *, row_number() OVER (ORDER BY modality_code, year, company) AS register FROM (
    SELECT modality_code, year, company, MAX(process_number) AS last_number FROM headers GROUP BY 1, 2, 3))
"""
ITEMS = HEADERS + """,
offers AS (SELECT o.*, i.failed FROM tender_offer o JOIN tender_item i USING (tender, material) WHERE i.annex = 'N'),
ranked AS (SELECT *, COUNT(*) OVER (PARTITION BY tender, line) AS n_offers, row_number() OVER (PARTITION BY tender, line
    ORDER BY unit_price ASC NULLS LAST, material, bidder, quantity, offer) AS rn FROM offers),
best AS (SELECT r.tender, r.line, r.quantity, r.failed, n_offers AS offers, v.material, v.avg_price, v.total AS avg_total
    FROM ranked r LEFT JOIN tender_item_avg v USING (tender, material) WHERE rn = 1),
items AS (SELECT * FROM best JOIN item_codes USING (material)),
status AS (SELECT i.tender, CAST(1 AS BIGINT) AS session, i.line FROM items i JOIN headers h USING (tender)
    WHERE NOT EXISTS (SELECT 1 FROM settled s WHERE s.tender = i.tender AND s.line = i.line)),
"""
BIDS = ITEMS + f"""
last_round AS (SELECT tender, bidder, material, MAX(round) AS round FROM bid_round GROUP BY 1, 2, 3),
bids_rounds AS (SELECT r.tender, r.bidder, b.line, code, b.quantity, r.price AS unit_price, b.quantity * r.price AS total,
    CASE WHEN b.failed = 'S' THEN 'D' ELSE 'C' END AS status, CAST(CASE WHEN r.winner = 'S' THEN 1 ELSE 0 END AS BIGINT) AS won, r.round
    FROM bid_round r JOIN last_round l USING (tender, bidder, material, round) JOIN best b USING (tender, material)
    JOIN item_codes USING (material)),
bids_direct AS (SELECT o.tender, bidder, o.line, code, quantity, unit_price, total, 'C' AS status, CAST(1 AS BIGINT) AS won,
    CAST(1 AS BIGINT) AS round FROM offers o JOIN tender t ON t.number = o.tender AND year >= {PARAMS.fiscal_year - PARAMS.direct_bid_years}
    JOIN item_codes USING (material) WHERE lowest = 1
    AND NOT EXISTS (SELECT 1 FROM bid_round l WHERE l.tender = o.tender AND l.material = o.material)),
bids AS (SELECT * FROM bids_rounds UNION ALL SELECT * FROM bids_direct),
rounds AS (SELECT * FROM bids b WHERE won = 1 AND NOT EXISTS (SELECT 1 FROM settled s
    WHERE s.tender = b.tender AND s.line = b.line AND s.bidder = b.bidder))
"""
BID_COLUMNS = """tender, bidder, line, code, quantity, unit_price, total, status, won, round, CAST(NULL AS VARCHAR) AS brand,
    CAST(1 AS BIGINT) AS session, 'S' AS item_bid, '00000001' AS lot, CASE WHEN quantity = 1 THEN 'V' ELSE 'Q' END AS control,
    quantity AS amended_quantity, unit_price AS amended_price"""
AWARDS = BIDS + """,
awarded AS (SELECT DISTINCT tender, line, bidder FROM rounds WHERE unit_price > 2000),
joined AS (SELECT r.tender, r.line, r.bidder, d.code, r.unit_price, r.total,
    CASE WHEN r.unit_price <> 0 THEN CAST(round(CAST(r.total / r.unit_price AS DECIMAL(24,8)), 2) AS DOUBLE) ELSE 0 END AS quantity
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tender, line, bidder ORDER BY unit_price, total) AS nr
    FROM rounds) WHERE nr = 1) r JOIN status s ON s.tender = r.tender AND s.line = r.line
    JOIN items d ON d.tender = r.tender AND d.line = r.line JOIN headers h ON h.tender = r.tender
    WHERE NOT EXISTS (SELECT 1 FROM awarded a WHERE a.tender = r.tender AND a.line = r.line AND a.bidder = r.bidder)),
awards AS (SELECT tender, line, bidder, code, CAST(0 AS BIGINT) AS centre, quantity, unit_price, quantity * unit_price AS total,
    CAST(1 AS BIGINT) AS won, 'C' AS status, CAST(1 AS BIGINT) AS last_session, quantity AS amended_quantity,
    unit_price AS amended_price, quantity * unit_price AS amended_total, 'Q' AS control, CAST(NULL AS VARCHAR) AS brand FROM joined),
approved AS (SELECT tender, CAST(approved + INTERVAL 1 YEAR AS DATE) AS valid_until FROM headers
    WHERE price_register = 'S' AND approved IS NOT NULL)
"""


class Chain:
    """The plan frames in their order; items, bids and rounds are loaded tables read back, all placed by their tender."""

    def __init__(self, t):
        self.e = Entities(t)

    @cached_property
    def headers(self):
        return tenders.tenders(self.e.tender, self.e.modality_names, PARAMS)["tenders"]

    @cached_property
    def header_keys(self):
        return tenders.known_tenders(self.e.tender)

    @cached_property
    def offers(self):
        e = self.e
        opened = tenders.open_offers(e.placed_offer, e.catalog_item, e.tender_item, e.tender, e.item_codes)
        return written_by(opened, "offers", "tender")

    @cached_property
    def items(self):
        best = tenders.best_offers(self.offers, self.e.tender_item_avg)
        return written_by(tenders.tender_items(best), "tender-items", "tender")

    @cached_property
    def item_rows(self):
        """For the plans that need no code of the items: nothing is looked up or written for them."""
        e = self.e
        offers = tenders.open_offers(e.tender_offer, e.catalog_item, e.tender_item, e.tender)
        return tenders.tender_items(tenders.best_offers(offers, e.tender_item_avg), e.item_codes)

    @cached_property
    def settled(self):
        return tenders.by_tender(self.e.settled)

    @cached_property
    def status(self):
        return tenders.item_status(self.items, self.header_keys, self.settled)

    @cached_property
    def bids_rounds(self):
        return tenders.bids_rounds(self.e.bid_round, self.items, once=True)

    @cached_property
    def bids_direct(self):
        e = self.e
        return tenders.bids_direct(self.offers, e.tender, e.bid_round, None, PARAMS)

    @cached_property
    def bids(self):
        return written_by(self.bids_rounds.unionByName(self.bids_direct), "bids", "tender")

    @cached_property
    def rounds(self):
        return written_by(tenders.winning_rounds(self.bids, self.settled), "winning-rounds", "tender")

    @cached_property
    def award_rows(self):
        awarded = self.rounds.filter("unit_price > 2000")
        return tenders.awards(
            self.rounds, self.status, tenders.item_details(self.items), self.header_keys, self.bids, awarded
        )

    @cached_property
    def awards(self):
        return written_by(self.award_rows, "awards", "tender")


@query(W + HEADERS + "SELECT * FROM headers")
def p_tenders(t):
    return Chain(t).headers


@query(
    W + HEADERS + """SELECT number, modality FROM tender WHERE modality NOT IN (SELECT modality FROM modality_list)"""
)
def p_tenders_rejected(t):
    e = Entities(t)
    return tenders.tenders(e.tender, e.modality_names, PARAMS)["rejected"].select("number", "modality")


@query(W + HEADERS + "SELECT * FROM register")
def p_modality_register(t):
    return tenders.modality_register(Chain(t).headers)


@query(W + HEADERS + "SELECT tender, register FROM headers LEFT JOIN register USING (modality_code, year, company)")
def p_tender_register_link(t):
    headers = Chain(t).headers
    return tenders.with_register(headers, tenders.modality_register(headers)).select("tender", "register")


@query(
    W + HEADERS + """SELECT tender, CAST(1 AS BIGINT) AS session, dated AS held, delivery_time, mode, closed, close_time,
    'T' AS session_for, 'O' AS reason FROM headers WHERE tender NOT IN (SELECT tender FROM held_sessions)"""
)
def p_sessions(t):
    c = Chain(t)
    return tenders.sessions(c.headers, c.e.held_sessions)


@query(W + "SELECT tender, bidder, substr(p.name, 1, 40) AS name, 'A' AS status FROM tender_bidder JOIN person p ON p.number = bidder")
def p_tender_bidders(t):
    e = Entities(t)
    return tenders.tender_bidders(e.tender_bidder, e.person, e.tender)["bidders"]


@query(
    W + """SELECT CAST(1 AS BIGINT) AS session, tender, bidder, 'S' AS enabled, 'A' AS status, tax_id, representative
    FROM tender_bidder JOIN person p ON p.number = bidder"""
)
def p_session_bidders(t):
    e = Entities(t)
    return tenders.tender_bidders(e.tender_bidder, e.person, e.tender)["session_bidders"]


@query(
    W + ITEMS.rstrip().rstrip(",") + """ SELECT tender, line, material, code, quantity, avg_price, avg_total AS total, offers, 'C' AS kind,
    CAST(0 AS BIGINT) AS centre, 'N' AS reduced, '00000001' AS lot, failed FROM items"""
)
def p_tender_items(t):
    return Chain(t).items


@query(
    W + ITEMS.rstrip().rstrip(",") + """ SELECT tender, line, line AS code, quantity, avg_total AS value, quantity AS added_quantity,
    avg_total AS added_value, CAST(0 AS BIGINT) AS centre, 'C' AS kind FROM items"""
)
def p_tender_item_funding(t):
    return tenders.item_funding(Chain(t).item_rows)


@query(
    W + ITEMS.rstrip().rstrip(",") + """ SELECT tender, line, code, quantity, avg_price, avg_total AS total, CAST(0 AS BIGINT) AS centre,
    line AS item FROM items"""
)
def p_tender_item_details(t):
    return tenders.item_details(Chain(t).items)


@query(
    W + ITEMS.rstrip().rstrip(",") + """ SELECT DISTINCT 'Lote 00000001' AS description, '00000001' AS lot, tender FROM items
    WHERE tender NOT IN (SELECT tender FROM lotted)"""
)
def p_lots(t):
    c = Chain(t)
    return tenders.lots(c.item_rows, c.e.lotted)


@query(W + ITEMS.rstrip().rstrip(",") + " SELECT tender, session, line, 'I_ENCERRAMENTO' AS screen FROM status")
def p_item_status(t):
    return Chain(t).status


@query(W + BIDS + f"SELECT {BID_COLUMNS} FROM bids_rounds")
def p_bids_rounds(t):
    return written_by(Chain(t).bids_rounds, "bids-rounds", "tender")


@query(W + BIDS + f"SELECT {BID_COLUMNS} FROM bids_direct")
def p_bids_direct(t):
    return Chain(t).bids_direct


@query(
    W + BIDS + """SELECT CAST(1 AS BIGINT) AS session, CAST(1 AS BIGINT) AS round, bidder, line, unit_price, total, 'F' AS status,
    won, tender FROM rounds"""
)
def p_winning_rounds(t):
    return Chain(t).rounds


@query(
    W + BIDS + """SELECT tender, CAST(1 AS BIGINT) AS last_session, bidder, line, unit_price, total, status, won FROM bids b
    WHERE NOT EXISTS (SELECT 1 FROM settled s WHERE s.tender = b.tender AND s.line = b.line AND s.bidder = b.bidder)"""
)
def p_final_bids(t):
    c = Chain(t)
    return written_by(tenders.final_bids(c.bids, c.settled), "final-bids", "tender")


@query(W + AWARDS + "SELECT * FROM awards")
def p_awards(t):
    return Chain(t).awards


@query(W + AWARDS + "SELECT * FROM awards")
def award_join(t):
    return Chain(t).awards


def _register(c, award):
    e = c.e
    keys = ["tender", "bidder", "code", "centre", "line"]
    loaded = award.filter("quantity > 45").select(*keys)
    return tenders.price_register(
        c.headers, award, {"register_docs": e.held_sessions, "register_prices": loaded, "register_history": loaded.filter("line > 3")}
    )


REGISTER_COLUMNS = """tender, bidder, code, centre, line, CAST(0 AS BIGINT) AS version, quantity, unit_price, total, won, status,
    'S' AS last"""
SAME = "x.tender = a.tender AND x.bidder = a.bidder AND x.code = a.code AND x.line = a.line AND x.quantity > 45"


@query(
    W + AWARDS + f"""SELECT {REGISTER_COLUMNS}, valid_until, CAST(0 AS DOUBLE) AS delivered FROM awards a JOIN approved USING (tender)
    WHERE NOT EXISTS (SELECT 1 FROM awards x WHERE {SAME})"""
)
def p_price_register(t):
    c = Chain(t)
    return written_by(_register(c, c.awards)["register_prices"], "register-prices", "tender")


@query(
    W + AWARDS + """SELECT DISTINCT tender, CAST(0 AS BIGINT) AS version, valid_until, 'S' AS last FROM approved
    WHERE tender NOT IN (SELECT tender FROM held_sessions)"""
)
def p_price_register_docs(t):
    c = Chain(t)
    return _register(c, c.award_rows)["register_docs"]  # no award is read for it


@query(
    W + AWARDS + f"""SELECT {REGISTER_COLUMNS}, brand FROM awards a JOIN approved USING (tender)
    WHERE NOT EXISTS (SELECT 1 FROM awards x WHERE {SAME} AND x.line > 3)"""
)
def p_price_register_history(t):
    c = Chain(t)
    return written_by(_register(c, c.awards)["register_history"], "register-history", "tender")


@query(
    W + AWARDS + f""", line_of AS (SELECT tender, material, MIN(line) AS line FROM items GROUP BY 1, 2),
    extra AS (SELECT tender, line, added FROM (SELECT t.tender, material, {EXACT.format('quantity')} AS added FROM request_line l
        JOIN request r ON r.number = l.request AND r.type = 2 JOIN request_tender t ON t.request = l.request GROUP BY 1, 2)
        JOIN line_of USING (tender, material)),
    price AS (SELECT tender, line, unit_price AS new_price FROM (SELECT *, row_number() OVER (PARTITION BY tender, material
        ORDER BY starts DESC NULLS FIRST, unit_price) AS rn FROM price_adjustment) JOIN line_of USING (tender, material) WHERE rn = 1)
    SELECT a.* EXCLUDE (amended_quantity, amended_price, amended_total),
        quantity + COALESCE(added, 0) AS amended_quantity, COALESCE(new_price, unit_price) AS amended_price,
        CASE WHEN new_price IS NOT NULL THEN (quantity + COALESCE(added, 0)) * new_price
        WHEN added IS NOT NULL THEN (quantity + added) * unit_price ELSE total END AS amended_total
    FROM awards a LEFT JOIN extra USING (tender, line) LEFT JOIN price USING (tender, line)"""
)
def p_amendments(t):
    c = Chain(t)
    e = c.e
    return tenders.amendments(
        c.awards, c.items, e.request, e.request_line, e.request_tender, e.price_adjustment, on_miss="skip"
    )
