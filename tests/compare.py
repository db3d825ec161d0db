"""Side-by-side comparison of a Spark result with its SQL twin."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

INTEGERS = {"tinyint", "smallint", "int", "bigint", "hugeint", "integer"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _kind(name: str) -> str:
    name = name.lower().replace("varchar", "string")
    return "integer" if name in INTEGERS else name


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, rows. Empty when both agree exactly."""
    expected = connection.sql(sql)
    types = {n: _kind(str(t)) for n, t in zip(expected.columns, expected.types)}
    found = {f.name: _kind(f.dataType.simpleString()) for f in result.schema}
    types = {n: t.replace(" ", "") for n, t in types.items()}
    problems = []
    if sorted(types) != sorted(found):
        return [f"columns {sorted(set(types) ^ set(found))}"]
    for name in sorted(types):
        if types[name] != found[name]:
            problems.append(f"{name}: {found[name]} is not {types[name]}")
    names = sorted(types)
    # the written form tells 1.5 from 1.50 and 0.0 from -0.0
    left = Counter(repr(tuple(row)) for row in result.select(*names).collect())
    right = Counter(
        repr(row)
        for row in expected.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    )
    if left != right:
        extra, missing = left - right, right - left
        problems.append(
            f"{sum(extra.values())} unexpected, {sum(missing.values())} missing of"
            f" {sum(right.values())} rows; e.g. {next(iter(extra), None)} / {next(iter(missing), None)}"
        )
    return problems
