"""Whole loads: every plan of a module in dependency order, into one target folder.

Each source is read once and landed; each target table is written once and read back by the plans
that build on it, so no plan computes another plan's result again.  Rows that do not make it lie in
``rejected/``.  ``reconciled/<module>`` has for every plan the rows it should have made (counted from its
sources), those it wrote and those it left out (both observed while they were written), and
``reconciled/<module>_texts`` what cleanup and column widths take from each text column.
"""

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlift.constants import ADJUSTMENT_KIND, ASSET_GROUP, MOVEMENT_KINDS
from ledgerlift.functions.text import join_loose, overlong, unheld
from ledgerlift.operators.lookups import duplicate_keys
from ledgerlift.operators.numbering import kept
from ledgerlift.operators.picks import best_with_ties, matching, null_safe, unmatched
from ledgerlift.params import RunParams
from ledgerlift.plans import assets, catalog, fleet, orders, quotes, stock, tenders
from ledgerlift.session import listed, read_text, remove, scratch, write_text, written
from ledgerlift.sources import slices, writer
from ledgerlift.sources.reader import cast_to, fits
from ledgerlift.sources.schema import LOOKUP_KEYS, SLICES, TEXT_WIDTHS, contract


class DuplicateKeyError(ValueError):
    """A table that plans look rows up in holds a key twice."""


class LoadConflictError(RuntimeError):
    """Another load has published into the folder meanwhile."""


class Target:
    """A folder of loaded tables.

    Every write of a table goes to a new folder of its own.  Which folders make up a table stands in a manifest
    (``_tables/<number>``), and a load publishes all its tables at once, by the next manifest: one that fails leaves the
    tables of the load before as they were, but for its rejected rows, which show what was wrong.  Outside of
    :meth:`load` each write is published at once.  Folders that neither the latest manifest nor the one before names are
    removed, so that a reader may finish.  One load at a time may write to a folder; of two, the second to publish fails.
    """

    MANIFESTS = "_tables"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        #: Entity -> (extracted, loaded, rejected): numbers, or frames counted by :meth:`reconcile`.
        self.counts: dict[str, tuple[int | DataFrame, ...]] = {}
        #: (entity, column, width, rows with letters outside the code page, rows that are cut)
        self.texts: list[tuple[str, str, int | None, int, int]] = []
        #: Rows written last, by table.
        self.rows: dict[str, int] = {}
        self.loading = False
        self.made: list[str] = []
        #: Table name -> (path, origin) of its parts, as this target sees it.
        self.tables: dict[str, list[list[str | None]]] = {}
        self._follow()

    def _follow(self) -> None:
        """See the tables as last published."""
        self.version = max(self._manifests(), default=0)
        self.tables = self._manifest(self.version)

    def _manifests(self) -> list[int]:
        return [int(n) for n in listed(self.spark, f"{self.folder}/{self.MANIFESTS}") if n.isdigit()]

    def _manifest(self, number: int) -> dict[str, list[list[str | None]]]:
        return json.loads(read_text(self.spark, f"{self.folder}/{self.MANIFESTS}/{number:09d}")) if number else {}

    def _publish(self) -> None:
        numbers = self._manifests()
        if max(numbers, default=0) != self.version:
            raise LoadConflictError(f"another load has published into {self.folder}")
        before = self._manifest(self.version)
        self.version += 1
        write_text(self.spark, f"{self.folder}/{self.MANIFESTS}/{self.version:09d}", json.dumps(self.tables))
        kept = {path for tables in (before, self.tables) for parts in tables.values() for path, _ in parts}
        for number in sorted(numbers)[:-1]:
            for parts in self._manifest(number).values():
                for path, _ in parts:
                    if path not in kept:
                        remove(self.spark, self._absolute(path))
            remove(self.spark, f"{self.folder}/{self.MANIFESTS}/{number:09d}")

    @contextmanager
    def load(self) -> Iterator[None]:
        """Publish what is written inside together at the end."""
        self._follow()
        before, self.loading, self.made = dict(self.tables), True, []
        self.counts, self.texts = {}, []
        try:
            yield
            self._publish()
        except BaseException as broken:
            rejected = {name: parts for name, parts in self.tables.items() if name.startswith("rejected/")}
            if isinstance(broken, LoadConflictError):
                self._follow()
            else:
                self.tables = before | rejected
                self._publish()
            raise
        finally:
            self.loading = False
            named = {path for parts in self.tables.values() for path, _ in parts}
            for path in self.made:
                if path not in named:
                    remove(self.spark, self._absolute(path))

    def _absolute(self, path: str) -> str:
        return f"{self.folder}/{path}"

    def _write(self, name: str, df: DataFrame, by: Sequence[str] = (), label: str | None = None) -> str:
        path = f"{name}/{uuid.uuid4().hex}"
        self.made.append(path)
        if by:  # an observation above would hide the order of the rows
            writer.append(df, self._absolute(path), by)
        else:
            seen = Observation()
            writer.append(df.observe(seen, F.count(F.lit(1)).alias("n")), self._absolute(path))
            self.rows[label or name] = seen.get["n"]
        return path

    def _set(self, name: str, parts: list[list[str | None]]) -> None:
        if not self.loading:
            self._follow()
        self.tables[name] = parts
        if not self.loading:
            self._publish()

    def path(self, name: str) -> str:
        """The folder of a table that has one part."""
        (path, _), = self.tables[name]
        return self._absolute(path)

    def exists(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        """The table; slices of several origins come with their ``origin``."""
        found = None
        for path, origin in self.tables[name]:
            part = self.spark.read.parquet(self._absolute(path))
            part = part if origin is None else part.withColumn("origin", F.lit(origin))
            found = part if found is None else found.unionByName(part)
        return found

    def refresh(self, name: str, df: DataFrame, unique: Sequence[str] = ()) -> DataFrame:
        """Replace the table; its ``unique`` keys, by which plans look rows up, may occur once."""
        path = self._write(name, df)
        self._set(name, [[path, None]])
        back = self.spark.read.schema(df.schema).parquet(self._absolute(path))
        if unique:
            self.audit_keys(name, back, unique)
        return back

    def land(self, name: str, df: DataFrame, by: Sequence[str]) -> DataFrame:
        """Replace a table partitioned ``by`` columns."""
        path = self._write(name, df, by)
        self._set(name, [[path, None]])
        return self.spark.read.schema(df.schema).parquet(self._absolute(path))

    def audit_keys(self, name: str, df: DataFrame, keys: Sequence[str]) -> None:
        """Write keys held twice to ``rejected/duplicates/<name>`` and stop if there are any."""
        audit = self.refresh(f"rejected/duplicates/{name}", duplicate_keys(df, keys))
        if not audit.isEmpty():
            raise DuplicateKeyError(f"{name}: {', '.join(keys)} not unique, see {self.path(f'rejected/duplicates/{name}')}")

    def reject(self, name: str, df: DataFrame) -> int:
        """Write rows that a plan leaves out to ``rejected/<name>``; their number."""
        self.refresh(f"rejected/{name}", df.drop(slices.SLICE))
        return self.rows[f"rejected/{name}"]

    def note(self, entity: str, extracted: int | DataFrame, loaded: int | DataFrame | str, rejected: int | DataFrame = 0) -> None:
        """What a plan should have made, what it wrote (a name: the rows written last) and what it left out.

        A frame stands for its number of rows, or for the sum of its column ``_n``.
        """
        self.counts[entity] = (extracted, self.rows[loaded] if isinstance(loaded, str) else loaded, rejected)

    def settle(
        self, entity: str, wanted: DataFrame, made: DataFrame, on: dict[str, str], loaded: int | DataFrame | str, name: str | None = None
    ) -> None:
        """Write the rows of ``wanted`` that ``made`` lacks to ``rejected/<name or entity>`` and note the counts.

        ``wanted`` has a row for each that the plan should make; so one that comes out twice shows as well.
        """
        self.note(entity, wanted, loaded, self.reject(name or entity.replace(" ", "_"), unmatched(wanted, made, on)))

    def reconcile(self, module: str) -> DataFrame:
        """Write the noted counts and whether extracted = loaded + rejected; frames are counted in one job.

        A row for each plan and column of text reaches the driver, a number set by the module, not by the data.
        """
        stages = ("extracted", "loaded", "rejected")
        known, frames = {}, []
        for entity, parts in self.counts.items():
            for stage, part in zip(stages, parts):
                if isinstance(part, DataFrame):
                    n = F.coalesce(F.sum("_n"), F.lit(0)) if "_n" in part.columns else F.count(F.lit(1))
                    frames.append(part.agg(n.cast("bigint").alias("n")).select(F.lit(entity).alias("e"), F.lit(stage).alias("s"), "n"))
                else:
                    known[entity, stage] = part
        if frames:
            known |= {(r.e, r.s): r.n for r in reduce(DataFrame.unionByName, frames).collect()}
        rows = [(entity, *(known[entity, stage] for stage in stages)) for entity in self.counts]
        texts = self.spark.createDataFrame(self.texts, "entity string, column string, width int, cleaned bigint, cut bigint")
        self.counts, self.texts = {}, []
        self.refresh(f"reconciled/{module}_texts", texts)
        counted = self.spark.createDataFrame(rows, "entity string, extracted bigint, loaded bigint, rejected bigint")
        return self.refresh(f"reconciled/{module}", counted.withColumn("balanced", F.expr("extracted = loaded + rejected")))

    def refresh_slice(self, name: str, origin: str, df: DataFrame) -> DataFrame:
        """Replace the rows of one origin, also by none; the table keeps those of the others.

        All origins of a table have the same columns.
        """
        others = [part for part in self.tables.get(name, []) if part[1] != origin]
        self._set(name, [*others, [self._write(name, df, label=f"{name}/{origin}"), origin]])
        return self.read(name)

    def append_absent(self, name: str, rows: Callable[[DataFrame], DataFrame], like: DataFrame) -> DataFrame:
        """Append what ``rows`` finds missing in the loaded table (``like`` before the first load)."""
        known = self.exists(name)
        added = [self._write(name, rows(self.read(name) if known else like.limit(0))), None]
        self._set(name, [*self.tables.get(name, []), added])
        return self.read(name)

    def numbers(
        self, register: str, rows: DataFrame, keys: Sequence[str], order: Sequence[Column], within: Sequence[str] = (), start: int = 0
    ) -> DataFrame:
        """``rows`` with the numbers ``n`` of their keys: those given by an earlier load, or the next ones.

        ``registers/<register>`` keeps every number ever given, so that new rows shift no older number and none is
        given twice; numbers of keys that are gone stay unused.
        """
        name = f"registers/{register}"
        given = self.read(name) if self.exists(name) else rows.select(*keys, F.lit(0).cast("bigint").alias("n")).limit(0)
        added = self.append_absent(name, lambda _: kept(given, rows, keys, order, within, start), given)
        return null_safe(rows, added, keys, "inner")


def checked(sources: Mapping[str, DataFrame], target: Target) -> dict[str, DataFrame]:
    """Sources cast to their contracts; rows that do not fit go to ``rejected/<entity>``.

    Each source is read once, to be landed with a flag under ``landed/<entity>``; good and rejected rows are read from there.
    Entities with a year are landed in slices by year, of which plans read those they filter by (see :mod:`slices`).
    """
    good = {}
    for name, df in sources.items():
        kind = contract(name)
        flagged = df.withColumn("_fits", fits(df, kind))
        by = ["_fits"]
        if name in SLICES:
            column, key = SLICES[name]
            flagged = flagged.withColumn(slices.SLICE, slices.slice_of(F.col(column), kind[column].dataType))
            by.append(slices.SLICE)
        counted = Observation()
        losses = {
            (column, width): tuple(
                F.count_if(F.col("_fits") & lost) for lost in (unheld(F.col(column).cast("string")), overlong(F.col(column).cast("string"), width))
            )
            for column, widths in TEXT_WIDTHS.get(name, {}).items() for width in widths
        }
        seen = flagged.observe(
            counted, F.count(F.lit(1)).alias("n"), F.count_if("_fits").alias("good"),
            *(c.alias(f"_{what}_{i}") for i, pair in enumerate(losses.values()) for what, c in zip(("cleaned", "cut"), pair)),
        )
        landed = target.land(f"landed/{name}", slices.clustered(seen, by, key) if name in SLICES else seen, by)
        good[name] = cast_to(landed.filter("_fits"), kind, keep=by[1:])
        rejected = target.reject(name, landed.filter("NOT _fits").drop(*by))
        target.note(name, counted.get["n"], counted.get["good"], rejected)
        target.texts += [
            (name, *place, counted.get[f"_cleaned_{i}"], counted.get[f"_cut_{i}"]) for i, place in enumerate(losses)
        ]
        if name in LOOKUP_KEYS:
            target.audit_keys(name, good[name], LOOKUP_KEYS[name])
    return good


def load_catalog(s: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    note = target.note
    target.refresh("units", catalog.units(s["unit_of_measure"]))
    note("units", s["unit_of_measure"].select("code").distinct(), "units")
    groups = target.refresh("groups", catalog.groups(s["catalog_group"], s["service_group"], target.numbers))
    services = s["service_group"].select("number")
    note("groups", s["catalog_group"].filter("level = 0").select("number").unionByName(services), "groups")
    base = target.refresh_slice("subgroups", "base", catalog.subgroups(s["catalog_group"], s["service_group"], groups))
    base = base.filter("origin = 'base'").drop("origin")
    orphans = target.reject("subgroups", catalog.orphan_groups(s["catalog_group"]))
    lower = s["catalog_group"].filter("level > 0").select("parent_kind", "parent_number", "kind", "number", "name").distinct()
    note("subgroups", lower.select("number").unionByName(services), "subgroups/base", orphans)
    target.audit_keys("subgroups", base, ["group_code", "subgroup"])
    coded = catalog.items(s["catalog_item"], s["catalog_group"], s["service_item"], base, params, target.numbers)
    opened = target.refresh_slice("subgroups", "opened", coded["opened_subgroups"])
    target.audit_keys("all_subgroups", opened, ["group_code", "subgroup"])  # a number in use may have come from the source since
    target.refresh("items", coded["items"], ["family", "material"])
    ungrouped = target.reject("items", catalog.ungrouped_goods(s["catalog_item"], s["catalog_group"]))
    note("items", s["catalog_item"].select("number").unionByName(s["service_item"].select("number")), "items", ungrouped)
    target.refresh("destinations", catalog.destinations(s["store"], params))
    note("destinations", s["store"], "destinations")
    centres = catalog.cost_centres(s["org_unit"], s["stock_request"], s["authority"], params)
    target.refresh_slice("cost_centres", "unit", centres.withColumn("plate", F.lit(None).cast("string")))
    head = s["authority"].filter(F.col("company") == params.company).limit(1)
    note("cost centres", s["org_unit"].select(F.lit(1)).union(head.select(F.lit(1))), "cost_centres/unit")


def item_codes(target: Target, family: str) -> DataFrame:
    """Codes by material within one item family."""
    return target.read("items").filter(F.col("family") == family).select("material", "code")


def load_quotes(s: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    goods = item_codes(target, "1")
    own = slices.of_years(s["quote"], "year", params.fiscal_year, params.fiscal_year).select("number", "year", "doc_number")
    headers = target.refresh("quotes", quotes.quote_headers(s["quote"], s["quote_line"], params))
    target.settle("quotes", own, headers, {"number": "quote"}, "quotes")
    of_year = matching(s["quote_line"], own, {"quote": "number"})
    lines = target.refresh("quote_lines", quotes.quote_lines(s["quote"], s["quote_line"], goods, params))
    target.note("quote lines", of_year.select("quote", "line", "material", "brand").distinct(), "quote_lines")
    prices = target.refresh("quote_prices", quotes.quote_prices(s["quote"], s["quote_line"], params))
    target.note("quote prices", of_year, "quote_prices")
    bidders = quotes.quote_bidders(s["quote"], s["quote_line"], s["person"], params)
    named = target.refresh("quote_bidders", quotes.quote_totals(bidders, prices))
    pairs = of_year.select("quote", "bidder").distinct()
    target.settle("quote bidders", pairs, named, {"quote": "quote", "bidder": "bidder"}, "quote_bidders")
    target.refresh("quote_awards", quotes.quote_awards(lines, prices))
    target.note("quote awards", target.rows["quote_lines"], "quote_awards")


def load_tenders(s: Mapping[str, DataFrame], target: Target, params: RunParams, on_amendment_miss: str = "fail") -> None:
    note = target.note
    goods = item_codes(target, "1")
    loaded = tenders.tenders(s["tender"], s["modality_names"], params)
    rejected = target.reject("tenders", loaded["rejected"])
    register = target.refresh("modality_register", tenders.modality_register(loaded["tenders"]))
    headers = target.refresh("tenders", tenders.with_register(loaded["tenders"], register), ["tender"])
    note("tender headers", s["tender"], "tenders", rejected)
    note("modality register", headers.filter("modality_code IS NOT NULL").select("modality_code", "year").distinct(), "modality_register")
    of_tender = {"tender": "tender"}
    held = target.append_absent("tender_sessions", lambda known: tenders.sessions(headers, known), headers)
    note("tender sessions", headers, matching(held, headers, of_tender))
    bidders = tenders.tender_bidders(s["tender_bidder"], s["person"], s["tender"])
    target.refresh("tender_bidders", bidders["bidders"])
    target.refresh("session_bidders", bidders["session_bidders"])
    unnamed = target.reject("tender_bidders", tenders.unknown_bidders(s["tender_bidder"], s["person"], s["tender"]))
    note("tender bidders", s["tender_bidder"], "tender_bidders", unnamed)
    note("session bidders", s["tender_bidder"], "session_bidders", unnamed)

    offers = written(tenders.open_offers(s["tender_offer"], s["catalog_item"], s["tender_item"], s["tender"]), "offers")
    of_item = {"tender": "tender", "material": "material"}
    target.settle("tender offers", s["tender_offer"], offers, of_item, matching(s["tender_offer"], offers, of_item))
    best = tenders.best_offers(offers, s["tender_item_avg"])
    items = target.refresh("tender_items", tenders.tender_items(best, goods))
    note("tender items", offers.select("tender", "line").distinct(), "tender_items")
    details = target.refresh("tender_item_details", tenders.item_details(items))
    target.refresh("tender_item_funding", tenders.item_funding(items))
    for name in ("tender_item_details", "tender_item_funding"):
        note(name.replace("_", " "), target.rows["tender_items"], name)
    lots = target.append_absent("tender_lots", lambda known: tenders.lots(items, known), items)
    wanted = items.filter("lot IS NOT NULL").select("tender", "lot").distinct()
    note("tender lots", wanted, matching(lots, wanted, {"tender": "tender", "lot": "lot"}))
    status = target.append_absent("tender_item_status", lambda known: tenders.item_status(items, headers, known), items)
    of_line = {"tender": "tender", "line": "line"}
    known = matching(items, headers, of_tender)
    target.settle("tender item status", items.select("tender", "line", "code"), status, of_line, matching(status, known, of_line))

    bids = target.refresh(
        "bids",
        tenders.bids_rounds(s["bid_round"], items).unionByName(
            tenders.bids_direct(offers, s["tender"], s["bid_round"], goods, params)
        ),
    )
    # A bid of a last round on each line with its material, counted by material, and the winning offers.
    last = best_with_ties(s["bid_round"], ["tender", "bidder", "material"], "round").groupBy(*of_item).agg(F.count("*").alias("bids"))
    lines = items.groupBy(*of_item).agg(F.count("*").alias("lines"))
    recent = slices.of_years(s["tender"], "year", params.fiscal_year - params.direct_bid_years)
    won = matching(offers.filter("lowest = 1"), recent, {"tender": "number"}, unique=True)
    wanted = last.join(lines, [*of_item]).select((F.col("bids") * F.col("lines")).alias("_n"))
    note("bids", wanted.unionByName(won.select(F.lit(1).cast("bigint").alias("_n"))), "bids", matching(won, s["bid_round"], of_item))
    target.reject("bid_rounds", unmatched(s["bid_round"], items, of_item))
    # Rounds and final bids follow the bids of this load; the price register keeps what it has.
    rounds = target.refresh("winning_rounds", tenders.winning_rounds(bids, bids.limit(0)))
    note("winning rounds", bids.filter("won = 1"), "winning_rounds")
    target.refresh("final_bids", tenders.final_bids(bids, bids.limit(0)))
    note("final bids", target.rows["bids"], "final_bids")
    target.reject("tied_rounds", tenders.tied_rounds(rounds))
    award = target.refresh("awards_signed", tenders.awards(rounds, status, details, headers, bids, bids.limit(0)))
    target.settle("awards signed", rounds.select(*tenders.BID_KEYS).distinct(), award, tenders.BID_KEYS, "awards_signed", "awards")
    approved = headers.filter("price_register = 'S' AND approved IS NOT NULL").select("tender")
    priced = matching(award, approved, of_tender, unique=True)
    for name, wanted, on in (
        ("register_docs", approved, of_tender), ("register_prices", priced, tenders.PRICE_KEYS), ("register_history", priced, tenders.PRICE_KEYS),
    ):
        kept_rows = target.append_absent(name, lambda known, n=name: tenders.price_register(headers, award, {n: known})[n], award)
        note(name.replace("_", " "), wanted, matching(kept_rows, wanted, on))
    if on_amendment_miss == "skip":
        amended = [s[n] for n in ("request", "request_line", "request_tender", "price_adjustment")]
        target.reject("amendments", tenders.amendment_rejects(items, *amended))
    target.refresh("awards", tenders.amendments(
        award, items, s["request"], s["request_line"], s["request_tender"], s["price_adjustment"], on_amendment_miss
    ))
    note("awards", target.rows["awards_signed"], "awards")


def load_orders(s: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    note = target.note
    goods = item_codes(target, "1")
    register = target.read("tenders").filter("price_register = 'S'").select("tender")
    headers = target.refresh("orders", orders.order_headers(s["purchase_order"], s["order_line"], register, params, target.numbers))
    own = slices.of_years(s["purchase_order"], "year", params.fiscal_year, params.fiscal_year).select("number", "year", "doc_number")
    target.settle("orders", own, headers, {"number": "order_id"}, "orders")
    target.refresh("order_lines", orders.order_lines(headers, s["order_line"], s["order_annulment"], goods))
    note("order lines", matching(s["order_line"], own, {"order_id": "number"}), "order_lines")
    used = target.refresh("order_commitments", orders.order_commitments(headers, s["commitment"]))
    committed = headers.filter("commitment IS NOT NULL").select("order_id", "doc", "commitment")
    target.settle("order commitments", committed, used, {"order_id": "order_id"}, "order_commitments")
    blank = s["commitment"].withColumns({
        "order_id": F.lit(None).cast("bigint"), "order_doc": F.lit(None).cast("string"),
    })
    target.refresh("commitments", orders.committed(blank, used))
    note("commitments", s["commitment"], "commitments")
    net = written(orders.ordered_before(s["purchase_order"], s["order_line"], s["order_annulment"], goods, params), "ordered")
    tender_items = target.read("tender_items")
    balance = target.refresh("prior_balance", orders.placed_balance(net, tender_items, params))
    note("prior balance", net, "prior_balance", target.reject("prior_balance", orders.unplaced_balance(net, tender_items)))
    target.refresh("register_balance", orders.register_balance(balance, register))
    note("register balance", balance.join(register, "tender"), "register_balance")


def load_fleet(s: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    note = target.note
    named = target.refresh("drivers", fleet.drivers(s["driver"], s["holder"]))
    target.settle("drivers", s["driver"], named, {"person": "code"}, "drivers")
    target.refresh("vehicle_types", fleet.vehicle_types(s["vehicle_type"]))
    note("vehicle types", s["vehicle_type"], "vehicle_types")
    target.refresh("vehicle_makes", fleet.vehicle_makes(s["vehicle_make"], s["vehicle"]))
    note("vehicle makes", s["vehicle_make"], "vehicle_makes")
    vehicles = target.refresh("vehicles", fleet.vehicles(s["vehicle"], s["fuel_type"]))
    note("vehicles", s["vehicle"].select(join_loose(F.col("plate_letters"), F.col("plate_digits"))).distinct(), "vehicles")
    units = target.read("cost_centres").filter("origin = 'unit'")
    centres = target.refresh_slice("cost_centres", "vehicle", fleet.vehicle_cost_centres(vehicles, units, params, target.numbers))
    note("vehicle cost centres", target.rows["vehicles"], "cost_centres/vehicle")
    # Units may have taken a number that a vehicle was given by an earlier load.
    if target.reject("vehicle_centres", matching(centres.filter("origin = 'vehicle'"), units, {"centre": "centre"})):
        raise DuplicateKeyError(f"cost_centres: centre not unique, see {target.path('rejected/vehicle_centres')}")
    plated = centres.filter("plate IS NOT NULL").select("plate", "centre", "store")
    documents = written(fleet.fuel_documents(s["fuel_request"], s["vehicle"], plated, params), "fuel-documents")
    lines = target.refresh_slice("stock_lines", "fuel", fleet.fuel_lines(documents, s["fuel_request_line"], item_codes(target, "1")))
    lines = lines.filter("origin = 'fuel'").select("document")
    target.refresh_slice("stock_documents", "fuel", fleet.fuel_headers(documents, lines))
    # Left out are requests of an unknown vehicle, with their lines, and requests without lines.
    own = slices.of_years(s["fuel_request"], "issued", params.fiscal_year, params.fiscal_year)
    target.settle("fuel documents", own, lines, {"number": "document"}, "stock_documents/fuel")
    of_year = matching(s["fuel_request_line"], own, {"request": "number"})
    target.settle("fuel lines", of_year, documents, {"request": "document"}, "stock_lines/fuel")


def load_stock(s: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    """Opening stock and movements; each refreshes its own slice of the shared tables."""
    goods = item_codes(target, "1")
    opening = stock.opening_stock(s["inventory"], goods, params)
    moves = stock.stock_movements(
        s["movement"], s["movement_line"], s["stock_request"], s["stock_request_line"], goods, params
    )
    # columns that only fuel documents fill
    driver = {"driver": F.lit(None).cast("bigint")}
    ride = {"km": F.lit(None).cast("double"), "plate": F.lit(None).cast("string")}
    for origin, tables in (("opening", opening), ("movement", moves)):
        target.refresh_slice("stock_documents", origin, tables["headers"].withColumns(driver))
        target.refresh_slice("stock_lines", origin, tables["lines"].withColumns(ride))
    before = slices.of_years(s["inventory"], "year", params.fiscal_year - 1, params.fiscal_year - 1)
    target.note("opening stock", before.filter("month = 12 AND balance * price <> 0"), "stock_lines/opening")
    lost = target.reject("movement_lines", stock.unflagged(s["movement"], s["movement_line"], params))
    target.reject("stock_requests", stock.unflagged_requests(s["stock_request"], params))
    wanted = stock.expected(s["movement"], s["movement_line"], s["stock_request"], s["stock_request_line"], params)
    target.note("stock lines", wanted, "stock_lines/movement", lost)
    target.note("stock documents", target.read("stock_lines").filter("origin = 'movement'").select("document").distinct(), "stock_documents/movement")


def load_purchasing(sources: Mapping[str, DataFrame], target: Target, params: RunParams, **options) -> None:
    with scratch(target.spark), target.load():
        s = checked(sources, target)
        load_catalog(s, target, params)
        load_quotes(s, target, params)
        load_tenders(s, target, params, **options)
        load_orders(s, target, params)
        load_fleet(s, target, params)
        load_stock(s, target, params)
        target.reconcile("purchasing")


def load_assets(sources: Mapping[str, DataFrame], target: Target, params: RunParams) -> None:
    with scratch(target.spark), target.load():
        s = checked(sources, target)
        spark = target.spark
        note = target.note
        target.refresh("movement_kinds", assets.movement_kinds(spark))
        note("movement kinds", len(MOVEMENT_KINDS), "movement_kinds")
        target.refresh("adjustment_kinds", assets.adjustment_kinds(spark, params))
        note("adjustment kinds", len([ADJUSTMENT_KIND]), "adjustment_kinds")
        target.refresh("asset_groups", assets.asset_groups(spark, params))
        note("asset groups", len([ASSET_GROUP]), "asset_groups")
        target.refresh("writeoff_reasons", assets.writeoff_reasons(s["asset"], params))
        sold = (F.coalesce("writeoff_value", F.lit(0.0)) != 0).alias("sold")
        note("write-off reasons", s["asset"].filter("writeoff_reason IS NOT NULL").select("writeoff_mode", sold).distinct(), "writeoff_reasons")
        target.refresh("conditions", assets.conditions(s["asset_condition"], params))
        note("conditions", s["asset_condition"], "conditions")
        target.refresh("asset_kinds", assets.asset_kinds(s["asset_kind"], params))
        note("asset kinds", s["asset_kind"], "asset_kinds")
        target.refresh("departments", assets.departments(s["org_unit"], params))
        note("departments", s["org_unit"].filter("parent IS NULL"), "departments")
        sectors = target.refresh("sectors", assets.sectors(s["org_unit"], s["asset_placement"], params))
        target.settle("sectors", s["org_unit"].filter("parent IS NOT NULL"), sectors, {"number": "code"}, "sectors")
        target.reject("writeoff_modes", assets.unreadable_writeoffs(s["asset"]))
        register = assets.assets(s["asset"], s["asset_placement"], s["asset_valuation"], s["asset_kind"], params)
        moves = target.refresh_slice(
            "asset_ledger", "movement", assets.ledger(s["asset_placement"], s["asset_valuation"], s["depreciation"], params)
        ).filter("origin = 'movement'")
        unvalued = target.reject("asset_placements", assets.unvalued_placements(s["asset_placement"], s["asset_valuation"]))
        revalued = s["asset_valuation"].groupBy("asset").count().filter("count > 1")
        rows = [s["asset_placement"], s["depreciation"], revalued]
        note("asset ledger", reduce(DataFrame.unionByName, (df.select("asset") for df in rows)), "asset_ledger/movement", unvalued)
        balanced = target.refresh("assets", assets.balances(register, moves), ["asset"])
        target.refresh_slice("asset_ledger", "writeoff", assets.writeoffs(balanced, moves))
        note("asset write-offs", balanced.filter("closed IS NOT NULL"), "asset_ledger/writeoff")
        target.settle("asset register", s["asset"], balanced, {"number": "asset"}, "assets", "assets")
        target.reconcile("assets")


def table_counts(target: Target, names: list[str]) -> DataFrame:
    """Rows per loaded table, for the reconciliation report."""
    counts = [
        target.read(n).agg(F.count("*").alias("loaded")).select(F.lit(n).alias("table"), "loaded") for n in names
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result
