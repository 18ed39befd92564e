"""Compare a Spark result with a SQL result as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{name}`" for name in names]).collect()
    return names, Counter(tuple(row) for row in rows)


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


def difference(left: Counter, right: Counter, shown: int = 3) -> str:
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; "
        f"only left {sum(only_left.values())}: {list(only_left)[:shown]}; "
        f"only right {sum(only_right.values())}: {list(only_right)[:shown]}"
    )
