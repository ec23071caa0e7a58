"""Run registered queries beside their SQL twins in DuckDB and compare all values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL" if value is None else "NaN"
    if isinstance(value, float):
        return repr(value)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    return str(value)


def kind(name: str) -> str:
    name = str(name).lower()
    for spark, duck in (("bigint", "bigint"), ("long", "bigint"), ("integer", "int"), ("int", "int"),
                        ("varchar", "string"), ("boolean", "boolean"), ("hugeint", "hugeint")):
        if name == spark:
            return duck
    return name


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    names = sorted(df.columns)
    mine = sorted(tuple(plain(v) for v in row) for row in df.select(*names).collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns: {sorted(set(names) ^ set(columns))}"
    order = [columns.index(n) for n in names]
    theirs = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    types = {d[0]: kind(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    odd = {c: (k, types[c]) for c, k in df.dtypes if kind(k) != types[c]}
    if len(mine) != len(theirs):
        return f"rows: {len(mine)} against {len(theirs)}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(bad)} rows differ, first: {dict(zip(names, zip(*bad[0])))}"
    return f"types: {odd}" if odd else None


def main() -> None:
    from tickloom.catalog import ORACLES, QUERIES
    from tickloom.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in only or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = difference(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if found is None else 'DIFF' if name in ORACLES else 'rows'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
