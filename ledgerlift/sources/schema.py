"""Contracts of the source entities: column names, types and required values."""

from functools import cache

from pyspark.sql import types as T

from ledgerlift import constants as K

_KEYED_NAME = "number bigint NOT NULL, name string"

_DDL = {
    # catalog and organisation
    "unit_of_measure": "code string NOT NULL, name string",
    "catalog_group": "kind string NOT NULL, number bigint NOT NULL, name string, level int, parent_kind string, parent_number bigint",
    "service_group": _KEYED_NAME,
    "catalog_item": """number bigint NOT NULL, name string, group_kind string NOT NULL, group_number bigint NOT NULL,
        min_stock double, max_stock double, active string, unit_code string""",
    "service_item": "number bigint NOT NULL, name string, group_number bigint NOT NULL, unit_code string",
    "org_unit": "number bigint NOT NULL, name string, active string, parent bigint",
    "store": _KEYED_NAME,
    "person": _KEYED_NAME,
    "authority": "company bigint NOT NULL, authority string, body string",
    # quotes and tenders
    "quote": "number bigint NOT NULL, year bigint NOT NULL, doc_number bigint, issued date, tender bigint, subject string",
    "quote_line": """quote bigint NOT NULL, line bigint NOT NULL, material bigint NOT NULL, bidder bigint, quantity double,
        price double, brand string, lowest int""",
    "tender": """number bigint NOT NULL, year bigint NOT NULL, process_number bigint, doc_number string, subject string,
        price_register string, dated date, opened date, open_time string, delivery_time string, approved date, office string,
        external_code string, modality int, published date, closed date, close_time string, amount double""",
    "modality_names": "code bigint NOT NULL, name string",
    "tender_bidder": "tender bigint NOT NULL, bidder bigint NOT NULL, representative string, tax_id string",
    "tender_item": "tender bigint NOT NULL, material bigint NOT NULL, line bigint, annex string, failed string",
    "tender_offer": """tender bigint NOT NULL, material bigint NOT NULL, bidder bigint NOT NULL, line bigint NOT NULL,
        quantity double, unit_price double, total double, lowest int, offer date""",
    "tender_item_avg": "tender bigint NOT NULL, material bigint NOT NULL, avg_price double, total double",
    "bid_round": """tender bigint NOT NULL, bidder bigint NOT NULL, material bigint NOT NULL, round bigint, price double,
        winner string""",
    "request": "number bigint NOT NULL, type int",
    "request_line": "request bigint NOT NULL, material bigint NOT NULL, quantity double",
    "request_tender": "request bigint NOT NULL, tender bigint NOT NULL",
    "price_adjustment": "tender bigint NOT NULL, material bigint NOT NULL, unit_price double, starts date",
    # orders and stock
    "purchase_order": """number bigint NOT NULL, year bigint NOT NULL, doc_number bigint, sub_number int, commitment bigint,
        issued date, supplier bigint, payment_terms string, notes string, delivery_place string, budget_line bigint,
        expense_category bigint, expense_group bigint, expense_modality bigint, expense_element bigint, expense_detail bigint,
        link_group bigint, link_code bigint, tender bigint, unit bigint, parent bigint, store bigint, contract_number bigint,
        contract_year bigint""",
    "order_line": """order_id bigint NOT NULL, line bigint NOT NULL, material bigint NOT NULL, quantity double,
        unit_price double, total double""",
    "order_annulment": "order_id bigint NOT NULL, line bigint NOT NULL, quantity double, value double",
    "commitment": "number bigint NOT NULL, amount double, carried_year int",
    "inventory": "year bigint, month bigint, store bigint, material bigint NOT NULL, balance double, price double",
    "movement": "number bigint NOT NULL, year bigint, issued date, store bigint, supplier bigint",
    "movement_line": """movement bigint NOT NULL, line bigint NOT NULL, material bigint, quantity double, unit_price double,
        total double, direct string""",
    "stock_request": "number bigint NOT NULL, year bigint, issued date, store bigint, unit bigint, direct string",
    "stock_request_line": "request bigint NOT NULL, line bigint NOT NULL, material bigint, quantity double",
    # fleet
    "driver": "person bigint NOT NULL, licence string, licence_class string, licence_expires date",
    "holder": _KEYED_NAME,
    "vehicle_type": _KEYED_NAME,
    "vehicle_make": _KEYED_NAME,
    "fuel_type": _KEYED_NAME,
    "vehicle": """number bigint NOT NULL, plate_letters string, plate_digits string, name string, chassis string, colour string,
        built bigint, model_year bigint, registration string, acquired date, driver bigint, make bigint, vehicle_type bigint,
        fuel_type bigint, km double, notes string, sold date, licensed_until date, oil_change_km double""",
    "fuel_request": "number bigint NOT NULL, issued timestamp_ntz, supplier bigint, driver bigint, km double, vehicle bigint",
    "fuel_request_line": """request bigint NOT NULL, line bigint NOT NULL, material bigint, quantity double,
        unit_price double, total double""",
    # assets
    "asset": """number bigint NOT NULL, asset_plate string, name string, notes string, asset_kind bigint, condition bigint,
        acquired date, entered date, acquisition_value double, supplier bigint, acquisition_doc string, commitment string,
        committed date, closed date, writeoff_mode string, writeoff_reason string, writeoff_value double""",
    "asset_kind": "number bigint NOT NULL, name string, account string",
    "asset_condition": _KEYED_NAME,
    "asset_placement": "asset bigint NOT NULL, sequence bigint NOT NULL, unit bigint, started date, movement string",
    "asset_valuation": "asset bigint NOT NULL, valued date, base_value double, residual double, revalued string",
    "depreciation": "asset bigint NOT NULL, valued date, value double, month bigint, year bigint",
}

ENTITIES = tuple(_DDL)

#: Keys by which plans look rows up in an entity; each may occur once.
LOOKUP_KEYS = {
    "person": ["number"], "holder": ["number"], "modality_names": ["code"], "tender": ["number"],
    "tender_item_avg": ["tender", "material"], "commitment": ["number"], "asset_kind": ["number"], "fuel_type": ["number"],
}

#: Entities landed in slices: the column of their year or day, and the key by which others join them.
SLICES = {
    "quote": ("year", "number"), "tender": ("year", "number"), "purchase_order": ("year", "number"),
    "inventory": ("year", "material"), "movement": ("year", "number"), "stock_request": ("year", "number"),
    "fuel_request": ("issued", "number"),
}


#: Text columns that plans clean, and the widths to which they cut them (None: uncut).
TEXT_WIDTHS = {
    "unit_of_measure": {"code": [None], "name": [None]}, "catalog_group": {"name": [None]}, "service_group": {"name": [None]},
    "catalog_item": {"name": [None], "unit_code": [None]}, "store": {"name": [None]}, "org_unit": {"name": [K.UNIT_NAME_WIDTH]},
    "quote": {"subject": [None]}, "tender": {"subject": [K.SUBJECT_WIDTH], "office": [K.OFFICE_WIDTH]},
    "person": {"name": [K.BIDDER_WIDTH, K.QUOTE_BIDDER_WIDTH]}, "tender_bidder": {"representative": [K.BIDDER_WIDTH]},
    "holder": {"name": [K.DRIVER_WIDTH]}, "vehicle": {"name": [K.MODEL_WIDTH], "colour": [None]}, "asset": {"name": [None]},
}


@cache
def contract(entity: str) -> T.StructType:
    """Schema of a source entity (needs a running session)."""
    return T.StructType.fromDDL(_DDL[entity])
