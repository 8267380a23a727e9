"""Run the registered queries against their SQL in DuckDB.

    python tests/check_queries.py [sf_dir] [query ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def rows(columns: list[str], records) -> list[str]:
    """Rows with columns in order of name, sorted, values exact."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(record[i] for i in order)) for record in records)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {table.stem} as select * from '{table}'")
    return con


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str:
    got = query(spark, sf_dir)
    records = got.collect()
    if sql is None:
        return f"rows only: {len(records)}"
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    if sorted(got.columns) != sorted(columns):
        return f"MISMATCH columns {sorted(got.columns)} / {sorted(columns)}"
    a, b = rows(got.columns, records), rows(columns, found.fetchall())
    if a == b:
        return f"ok {len(a)}"
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"MISMATCH {len(a)} / {len(b)} rows; {list(only_a)[:2]}, {list(only_b)[:2]}"


def main() -> int:
    import __spark_entry__ as entry
    from clickspark.settings import spark_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = spark_session("check", "local[8]", 8, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = sorted(set(sql) - set(queries))
    for name in sys.argv[2:] or queries:
        begun = time.time()
        try:
            said = compare(spark, con, sf_dir, name, queries[name], sql.get(name))
        except Exception as error:  # report and go on to the next query
            said = f"MISMATCH {type(error).__name__}: {str(error)[:600]}"
        if "MISMATCH" in said:
            bad.append(name)
        print(f"{name:34s} {time.time() - begun:6.2f}s {said}", flush=True)
    print("bad:", bad)
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
