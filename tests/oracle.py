"""Compare a Spark result with the SQL of another engine: names, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else str(value)
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty when the results are equal."""
    result = con.execute(sql)
    other = {d[0]: str(d[1]) for d in result.description}
    mine = dict(df.dtypes)
    if set(mine) != set(other):
        return [f"columns {sorted(mine)} != {sorted(other)}"]
    names = sorted(mine)
    found = [
        f"type of {c}: {mine[c]} != {other[c]}" for c in names if TYPES.get(mine[c], mine[c]) != other[c]
    ]
    at = [list(other).index(c) for c in names]
    theirs = sorted((tuple(_cell(r[i]) for i in at) for r in result.fetchall()), key=_key)
    ours = sorted((tuple(_cell(r[c]) for c in names) for r in df.collect()), key=_key)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ over {names}, e.g. {bad[0][0]} != {bad[0][1]}")
    return found
