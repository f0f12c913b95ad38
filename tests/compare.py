"""Order-free comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

SPARK_TO_DUCK = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        files = f"{file}/*.parquet" if file.is_dir() else file
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{files}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types or rows; empty when the results are equal."""
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found = [
        f"{name}: {SPARK_TO_DUCK.get(kind, kind)} is {types.get(name, 'absent')}"
        for name, kind in df.dtypes if SPARK_TO_DUCK.get(kind, kind) != types.get(name)
    ]
    found += [f"{name} is missing" for name in types if name not in df.columns]
    actual = _rows(df.columns, df.collect())
    if actual != expected:
        found.append(f"rows {actual.total()} and {expected.total()}")
        found.append(f"only in Spark: {list((actual - expected).items())[:3]}")
        found.append(f"only in SQL: {list((expected - actual).items())[:3]}")
    return found
