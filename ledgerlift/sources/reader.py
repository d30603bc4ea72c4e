"""Sources: parquet tables and relational tables, read against a contract."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """The source does not have the columns a plan needs."""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    split_by: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a relational read.  With ``split_by`` the table is read in
    ``splits`` parallel ranges of that column; a query cannot be split."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query, not both")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    options["dbtable" if table else "query"] = table or query
    if split_by:
        if query or bounds is None:
            raise ValueError("a split read needs a table and the bounds of its split column")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Relational source; empty text becomes NULL as the source system has it."""
    return empty_as_null(spark.read.format("jdbc").options(**jdbc_options(**options)).load())


def empty_as_null(df: DataFrame) -> DataFrame:
    return df.select(*(
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ))


def conform(df: DataFrame, contract: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows cast to the contract, and the rows that do not fit it (see :func:`fits`)."""
    ok = fits(df, contract)
    return cast_to(df.filter(ok), contract), df.filter(~ok)


def fits(df: DataFrame, contract: T.StructType) -> Column:
    """Whether a row keeps every value when it is cast to the contract.

    A missing column raises.  A row does not fit when a required value is NULL, a value cannot be
    cast, or it loses something: cast back, a number, date or time of day must be what it was, and a
    text must say no more than its target type holds (see :func:`_text_kept`).
    """
    absent = [f.name for f in contract.fields if f.name not in df.columns]
    if absent:
        raise ContractError(f"missing columns: {', '.join(absent)}")
    ok = F.lit(True)
    for f in contract.fields:
        value, own = F.col(f.name), df.schema[f.name].dataType
        cast = _cast(value, own, f.dataType)
        kept = cast.isNotNull()
        if isinstance(own, T.StringType):
            kept = kept & _text_kept(value, f.dataType)
        elif own != f.dataType:
            kept = kept & F.coalesce(cast.try_cast(own) == value, F.lit(False))
        ok = ok & F.when(value.isNull(), F.lit(f.nullable)).otherwise(kept)
    return ok


_DAY = r"\d{4,}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6}0*)?)?"


def _text_kept(text: Column, kind: T.DataType) -> Column:
    """Whether a text that can be cast to ``kind`` loses nothing in it.

    Numbers may have signs, leading zeros and zeros after their last place, but no more places than the target
    has; a date may have a time of day of zero, a time no more than six places of a second and no zone.  Types
    beyond these keep every text that can be cast.
    """
    said = F.trim(text)
    if isinstance(kind, T.IntegralType):
        return said.rlike(r"^[+-]?\d+(\.0*)?$")
    if isinstance(kind, T.DecimalType):
        # Of more digits than a decimal has, none may be lost either.
        exact = said.rlike(rf"^[+-]?(\d+(\.\d{{0,{kind.scale}}}0*)?|\.\d{{1,{max(kind.scale, 1)}}}0*)$")
        wide = said.try_cast(T.DecimalType(38, min(18, kind.scale + 6)))
        return exact | (said.rlike("[eE]") & F.coalesce(wide == said.try_cast(kind), F.lit(False)))
    if isinstance(kind, T.FractionalType):
        # A double keeps fifteen digits of any number.
        digits = F.regexp_replace(F.regexp_replace(said, "[eE].*$", ""), "[^0-9]", "")
        return F.length(F.regexp_replace(digits, "^0+|0+$", "")) <= (15 if isinstance(kind, T.DoubleType) else 6)
    if isinstance(kind, T.DateType):
        return said.rlike(rf"^{_DAY}([ T]0{{1,2}}:0{{1,2}}(:0{{1,2}}(\.0*)?)?)?$")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return said.rlike(rf"^{_DAY}([ T]{_CLOCK})?$")
    return F.lit(True)


def _cast(value: Column, own: T.DataType, kind: T.DataType) -> Column:
    """``value`` of type ``own`` as ``kind``, NULL where it cannot be; whole numbers in text may have zeros as places."""
    if isinstance(own, T.StringType) and isinstance(kind, T.IntegralType):
        value = value.try_cast(T.DecimalType(38, 6))
    return value.try_cast(kind)


def cast_to(df: DataFrame, contract: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of the contract in its types, and those to ``keep`` as they are."""
    own = df.schema
    return df.select(*(_cast(F.col(f.name), own[f.name].dataType, f.dataType).alias(f.name) for f in contract.fields), *keep)
