"""Drivers, vehicles and fuelling documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift import constants as K
from ledgerlift.functions import text as X
from ledgerlift.operators.lookups import lookup
from ledgerlift.operators.numbering import anew, highest
from ledgerlift.operators.picks import any_one, first_per_key, matching
from ledgerlift.params import RunParams
from ledgerlift.sources.slices import of_years


def drivers(driver: DataFrame, person: DataFrame) -> DataFrame:
    names = person.select(F.col("number").alias("person"), X.clean(F.col("name"), K.DRIVER_WIDTH).alias("name"))
    return driver.join(names, "person").select(
        F.col("person").alias("code"), "name", "licence", "licence_class", "licence_expires"
    )


def vehicle_types(vehicle_type: DataFrame) -> DataFrame:
    return vehicle_type.select(F.col("number").alias("code"), F.col("name").alias("description"))


def vehicle_makes(vehicle_make: DataFrame, vehicle: DataFrame) -> DataFrame:
    """Makes with the type of one of their vehicles (the lowest), type 1 for a make without vehicle."""
    kind = any_one(vehicle, "make", "vehicle_type")
    return lookup(vehicle_make, kind, {"number": "make"}, ["vehicle_type"], "null").select(
        F.col("number").alias("code"), F.col("name").alias("description"),
        F.coalesce("vehicle_type", F.lit(1).cast("bigint")).alias("vehicle_type"),
    )


def _plate():
    return X.join_loose(F.col("plate_letters"), F.col("plate_digits"))


def vehicles(vehicle: DataFrame, fuel_type: DataFrame) -> DataFrame:
    """The latest record of each plate; an unknown year or purchase date counts as latest."""
    order = [F.col("model_year").desc_nulls_first(), F.col("acquired").desc_nulls_first(), F.col("number").asc()]
    latest = first_per_key(vehicle.withColumn("plate", _plate()), ["plate"], order)
    fuel = fuel_type.select(F.col("number").alias("fuel_type"), F.substring("name", 1, 1).alias("fuel"))
    return latest.join(fuel, "fuel_type", "left").select(
        X.clean(F.col("plate")).alias("plate"), F.col("number").alias("sequence"),
        X.clean(F.col("name"), K.MODEL_WIDTH).alias("model"), "chassis", X.clean(F.col("colour")).alias("colour"), "built",
        "model_year", "registration", "acquired", "driver", "make", F.col("km").alias("initial_km"), "notes", "fuel",
        "sold", "licensed_until", "oil_change_km",
    )


def vehicle_cost_centres(coded_vehicles: DataFrame, cost_centre: DataFrame, params: RunParams, numbers=anew) -> DataFrame:
    """One cost centre per vehicle, numbered on from the centres in use; ``numbers`` gives them, anew or from a register."""
    given = numbers(
        "vehicle_centres", coded_vehicles.select("plate", "model"), ["plate"], [F.col("plate").asc()], start=highest(cost_centre, "centre")
    )
    numbered = given.withColumnRenamed("n", "centre")
    return numbered.select(
        F.lit(K.VEHICLE_AUTHORITY).alias("authority"), F.lit(K.VEHICLE_BODY).alias("body"),
        F.lit(K.DEFAULT_STORE).alias("store"), F.lit(K.DEFAULT_CENTRE).alias("sub_centre"),
        F.col("model").alias("name"), "centre", F.lit(params.company).cast("bigint").alias("company"),
        F.lit("N").alias("hidden"), "plate",
    )


def fuel_documents(fuel_request: DataFrame, vehicle: DataFrame, centres: DataFrame, params: RunParams) -> DataFrame:
    """Fuelling requests of the year under the cost centre of their vehicle; one without cost centre stops the run."""
    plates = vehicle.select(F.col("number").alias("vehicle"), X.clean(_plate()).alias("plate"))
    requests = of_years(fuel_request, "issued", params.fiscal_year, params.fiscal_year).join(plates, "vehicle")
    placed = lookup(requests, centres, {"plate": "plate"}, ["centre", "store"], "fail")
    year = F.year("issued").cast("bigint")
    company = F.lit(params.company).cast("bigint").alias("company")
    day = F.to_date("issued")
    return placed.select(
        company, F.col("number").alias("document"), X.doc_number(F.col("number"), year, 6).alias("doc"),
        X.pad_grow(F.col("number"), 6).alias("serial"), year.alias("year"), "store", "centre", day.alias("dated"),
        day.alias("entered"), day.alias("paid"), F.lit("S").alias("inbound"), F.lit("S").alias("outbound"),
        F.lit("P").alias("kind"), "supplier", F.lit("S").alias("passes_through"), "driver", "km", "plate",
    )


def fuel_lines(documents: DataFrame, fuel_request_line: DataFrame, items: DataFrame) -> DataFrame:
    """Lines of the fuelling documents; a fuel without item code stops the run."""
    heads = documents.select("document", "doc", "centre", "company", "store", "km", "plate")
    lines = fuel_request_line.withColumnRenamed("request", "document").join(heads, "document")
    coded = lookup(lines, items, {"material": "material"}, ["code"], "fail")
    both = {"quantity": "quantity", "unit_price": "price", "total": "total"}
    return coded.select(
        "document", "doc", "centre", "company", F.col("line").alias("item"), "code",
        *(F.col(c).alias(f"{n}_{side}") for c, n in both.items() for side in ("in", "out")), "store", "km", "plate",
    )


def fuel_headers(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """The documents that have lines."""
    return matching(documents.drop("km", "plate"), lines, {"document": "document"})


def fuelling(
    fuel_request: DataFrame,
    fuel_request_line: DataFrame,
    vehicle: DataFrame,
    centres: DataFrame,
    items: DataFrame,
    params: RunParams,
) -> dict[str, DataFrame]:
    """Fuelling documents of the year and their lines; a load writes the documents once for both."""
    documents = fuel_documents(fuel_request, vehicle, centres, params)
    asked = fuel_request_line.select(F.col("request").alias("document"))
    return {"headers": fuel_headers(documents, asked), "lines": fuel_lines(documents, fuel_request_line, items)}
