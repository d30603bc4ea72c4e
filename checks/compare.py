"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python -m checks.compare [--sf 0.01] [name ...]
"""

import argparse
import math
import time

import duckdb

from checks import load
from ledgerlift.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9e}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> list[str]:
    """What differs between the two results; empty when they agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    found = rows_of(df.columns, df.collect())
    notes = []
    if sorted(names) != sorted(df.columns):
        notes.append(f"columns {sorted(df.columns)} instead of {sorted(names)}")
    if len(found) != len(expected):
        notes.append(f"{len(found)} rows instead of {len(expected)}")
    if not notes and found != expected:
        wrong = [(a, b) for a, b in zip(found, expected) if a != b]
        notes.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    described = dict(row[:2] for row in con.execute(f"DESCRIBE {sql}").fetchall())
    for f in df.schema.fields:
        kind = TYPES.get(f.dataType.simpleString())
        if kind != described.get(f.name):
            notes.append(f"type {f.name}: {kind} instead of {described.get(f.name)}")
    return notes


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = load()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            notes = differences(df, con, sql[name]) if name in sql else [f"rows only: {df.count()}"]
        except Exception as error:  # noqa: BLE001 - a broken query is a finding
            notes = [str(error).strip()[:600]]
        bad += bool(notes)
        print(f"{name:28s} {time.time() - start:5.1f}s {'; '.join(notes) or 'ok'}", flush=True)
    print(f"{bad} with differences")


if __name__ == "__main__":
    main()
