"""Run a registered query and its SQL side by side. As a script: compare.py FOLDER [QUERY ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem documents pages conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            path = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"{value:.6f}"
    return "NULL" if value is None else str(value)


_KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP",
          "int": "INTEGER", "boolean": "BOOLEAN"}


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree in columns, types and rows, else what differs."""
    result = con.execute(sql)
    described = {c[0]: str(c[1]) for c in result.description}
    ours = {f.name: _KINDS[f.dataType.simpleString()] for f in spark_df.schema}
    if ours != described:
        return f"columns {sorted(set(ours.items()) ^ set(described.items()))}"
    names = sorted(ours)
    order = [c[0] for c in result.description]
    want = Counter(tuple(_norm(row[order.index(n)]) for n in names) for row in result.fetchall())
    have = Counter(tuple(_norm(row[n]) for n in names) for row in spark_df.collect())
    if want == have:
        return None
    missing, extra = list((want - have).elements()), list((have - want).elements())
    return f"{names}: {len(missing)} missing {sorted(missing)[:2]}, {len(extra)} extra {sorted(extra)[:2]}"


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as driver
    from parcelpay.session import local_session

    spark = local_session("8")
    con = connect(folder)
    failed = 0
    for name, build in driver.queries().items():
        if wanted and name not in wanted or name not in driver.oracle_sql():
            continue
        start = time.time()
        try:
            frame = build(spark, folder)
            problem = difference(frame, con, driver.oracle_sql()[name])
            rows = con.execute(f"SELECT count(*) FROM ({driver.oracle_sql()[name]}) q").fetchall()[0][0]
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", "?"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} {time.time() - start:.1f}s {problem or ''}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
