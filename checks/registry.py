"""Registered queries, each with the SQL that must give the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.sources.reader import read_table

#: SQL of a zero-padded number that keeps all digits of a longer one, of (number, width).
GROW = "CASE WHEN length(CAST({0} AS VARCHAR)) > {1} THEN CAST({0} AS VARCHAR) ELSE lpad(CAST({0} AS VARCHAR), {1}, '0') END"
#: SQL of a sum that does not depend on the order of addition.
EXACT = "CAST(SUM(CAST({} AS DECIMAL(28,8))) AS DOUBLE)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables as attributes: ``t.orders``, ``t.lineitem`` …"""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, self.folder, name)
        setattr(self, name, table)  # read the footer once per query
        return table


def query(sql: str):
    """Register a function of :class:`Tables` under its name, with its SQL."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        QUERIES[fn.__name__] = run
        SQL[fn.__name__] = sql
        return fn

    return register
