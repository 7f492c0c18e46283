"""Run queries beside their SQL and compare rows: ``python -m checks.compare [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

from checks.queries import ORACLES, QUERIES
from shelflens.session import build_session

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows in a canonical form: columns by name, nulls as text, numbers as doubles."""

    def plain(value):
        if value is None or value is pd.NA or value != value:
            return "null"
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, str):
            return value
        return repr(float(value))

    columns = sorted(frame.columns)
    return sorted(tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False, name=None))


def compare(spark, con, name: str, sf: str) -> str:
    start = time.time()
    mine = QUERIES[name](spark, sf).toPandas()
    middle = time.time()
    if name not in ORACLES:
        return f"rows only  {len(mine)} rows, {middle - start:.1f} s"
    theirs = con.execute(ORACLES[name]).df()
    end = time.time()
    times = f"{len(mine)} rows, {middle - start:.1f} s, sql {end - middle:.1f} s"
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"DIFFERENT columns {sorted(set(mine.columns) ^ set(theirs.columns))}, {times}"
    a, b = rows_of(mine), rows_of(theirs)
    if a == b:
        return f"same  {times}"
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"DIFFERENT {len(theirs)} sql rows, {times}\n   {only_a[:2]}\n   {only_b[:2]}"


def main() -> None:
    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in sys.argv[1:] or QUERIES:
        try:
            print(f"{name:30s} {compare(spark, con, name, sf)}", flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{name:30s} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main()
