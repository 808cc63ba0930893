"""Run registered queries on Spark and their oracle SQL on DuckDB and compare.

`python tests/compare.py [folder] [query ...]` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Type names that stand for the same thing on both sides.
SAME_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark result and an oracle result; empty when equal."""
    names = sorted(spark_df.columns)
    relation = con.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    spark_types = {n: SAME_TYPE.get(t, t) for n, t in spark_df.dtypes}
    oracle_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    problems = [
        f"type of {n}: {spark_types[n]} != {oracle_types[n]}"
        for n in names
        if spark_types[n] != oracle_types[n]
    ]
    ours = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=_key)
    order = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {order} FROM ({sql})").fetchall(), key=_key)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry

    from seriesmill.session import local_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = local_session("compare", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(arguments) > 1 and name not in arguments[1:]:
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            problems = compare(df, con, oracles[name]) if name in oracles else [f"no oracle ({df.count()} rows)"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if not problems else problems}", flush=True)
    print(f"{failed} with problems")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
