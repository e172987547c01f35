"""Run queries against their SQL: ``python tests/check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in (row[i] for i in order)) for row in rows]
    return sorted(plain, key=repr)


def compare(spark, con, sf_dir: str, run, sql: str | None) -> str:
    df = run(spark, sf_dir)
    found = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if sql is None:
        return f"rows only ({len(found)})"
    relation = con.sql(sql)
    if sorted(relation.columns) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} / {sorted(relation.columns)}"
    expected = rows_of(relation.columns, relation.fetchall())
    if found == expected:
        types = dict(zip(relation.columns, map(str, relation.types)))
        return f"ok ({len(found)}) " + " ".join(
            f"{c}:{t}/{types[c]}" for c, t in df.dtypes
            if {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}.get(t) != types[c]
        )
    odd = [pair for pair in zip(found, expected) if pair[0] != pair[1]][:2]
    return f"MISMATCH {len(found)}/{len(expected)} rows, columns {sorted(df.columns)}: {str(odd)[:1500]}"


def main() -> None:
    from newsloom.session import local_session
    from workload.oracles import ORACLES
    from workload.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    for name in names or QUERIES:
        start = time.time()
        try:
            result = compare(spark, con, sf_dir, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
