"""Row-exact comparison of a Spark result with its SQL restatement."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df, connection, sql: str) -> str:
    """Empty if both hold the same rows under the same names and value types."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = bag(names, answer.fetchall())
    found = bag(df.columns, [tuple(r) for r in df.collect()])
    if expected == found:
        return ""
    missing, extra = list((expected - found).items()), list((found - expected).items())
    return f"{len(missing)} missing, {len(extra)} extra rows: {missing[:2]} / {extra[:2]}"
