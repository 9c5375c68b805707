"""Compare Spark queries with their DuckDB answers, as multisets of rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents
    embeddings pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """Differences between the two answers; empty if they agree."""
    got = query(spark, sf_dir)
    columns = sorted(got.columns)
    rows = Counter(tuple(r) for r in got.select(*columns).collect())
    relation = con.sql(sql)
    if sorted(relation.columns) != columns:
        return [f"columns {columns} != {sorted(relation.columns)}"]
    picks = [relation.columns.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in picks) for r in relation.fetchall())
    problems = []
    if not want:
        problems.append("expected answer is empty")
    if rows != want:
        problems.append(f"{sum(rows.values())} rows, expected {sum(want.values())}")
        problems += [f"  only in Spark: {r}" for r in list((rows - want))[:3]]
        problems += [f"  only expected: {r}" for r in list((want - rows))[:3]]
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    names |= {"timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
    for name, dtype in got.dtypes:
        if names.get(dtype, dtype) != types[name]:
            problems.append(f"type of {name}: {dtype} vs {types[name]}")
    return problems


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problems = compare(spark, con, sf_dir, query, sql[name])
        except Exception as err:  # noqa: BLE001
            problems = [f"{type(err).__name__}: {str(err)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem)
    print("failed:", failed)


if __name__ == "__main__":
    main()
