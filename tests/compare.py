"""Compares the registered queries with their SQL twins.

``python tests/compare.py <folder of the tables> [query ...]``
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return _sorted_rows(names, cursor.fetchall())


def difference(spark, connection, query, sql, sf_dir) -> str | None:
    """What differs, or None."""
    names, rows = spark_rows(query(spark, sf_dir))
    sql_names, expected = sql_rows(connection, sql)
    if names != sql_names:
        return f"columns {names} and {sql_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows and {len(expected)}"
    for row, other in zip(rows, expected):
        if row != other:
            return f"{row} and {other}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from daybook.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = []
    for name, query in queries().items():
        if (wanted and name not in wanted) or name not in oracle_sql():
            continue
        start = time.time()
        try:
            found = difference(spark, connection, query, oracle_sql()[name], sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:500]}"
        if found:
            failed.append(name)
        print(f"{name}: {found or 'equal'} ({time.time() - start:.2f} s)", flush=True)
    print(f"differing: {failed}")


if __name__ == "__main__":
    main()
