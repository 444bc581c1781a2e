"""Compare a query's rows with its SQL twin in DuckDB: names, types, and every value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((value is not None, str(type(value)), value) for value in row)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; empty if there are none."""
    problems = []
    names = sorted(df.columns)
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(types) != names:
        return [f"columns {names} against {sorted(types)}"]
    for name, dtype in df.dtypes:
        if TYPES.get(dtype, dtype) != types[name]:
            problems.append(f"{name}: {dtype} against {types[name]}")
    mine = sorted((tuple(row[name] for name in names) for row in df.collect()), key=_key)
    quoted = ", ".join(f'"{name}"' for name in names)
    theirs = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    for a, b in zip(mine, theirs):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            problems.append(f"{names}: {str(a)[:300]} against {str(b)[:300]}")
            break
    return problems
